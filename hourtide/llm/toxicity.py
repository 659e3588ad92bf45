"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

1. A bounded number of labelled documents, the first by a hash of their ids, are the examples. Their words and how
   these begin are the terms; none is left out for want of evidence. A term's weight is its TF-IDF times the square of how
   far its share of toxic examples, drawn towards the common share as if 20 more examples were seen, lies from
   that on the log-odds scale. So what says nothing about the label hardly counts, whatever the number of examples.
2. One pass over all documents counts in how many of them each term occurs.
3. Equal example vectors become one entry with its numbers of good and bad examples. The terms that many entries have
   are rows of a matrix in short numbers, the others have postings. A batch of texts is compared with all entries at once: by a
   product with the matrix, and by the postings of its other terms. The light ones of these, whose weights together are no
   longer than a small length, add no more than that to any cosine and are left for later. Entries that may be among the k best
   after rounding and with the light terms are compared again, with all terms and in full precision. So the search is exact. The index
   is bounded by the number of examples and sent to every task; the matrix is made there, of a bounded number of cells.
4. Each near entry votes with its examples, weighted by its squared cosine over its distance; a small prior votes against.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourtide.llm.common import LOWER_BYTES, crc32_remainder, renamed, stage

#: Labelled documents that are examples: the bound of the model.
MOST_EXAMPLES = 2_500
#: How words begin, in so many letters (more before fewer), are terms besides whole words.
BEGINNINGS = (5,)
#: Examples of the common share that a term is taken to have been seen in besides its own.
SEEN_BEFORE = 20
NEAREST = 10
#: The length of the part of a text's vector that only near entries are compared with.
LIGHT = 0.03
#: Terms that one in so many entries has, or more, are rows of a matrix of at most so many cells.
FREQUENT, MOST_CELLS = 16, 1 << 22
#: Postings that are added at a time.
POSTINGS = 1 << 20
#: Added to a distance before it divides a vote.
SOFTEN = 0.1
PRIOR_WEIGHT = 1.0
#: The prior is the common share of toxic examples, but never so much that texts are toxic without evidence.
MOST_PRIOR = 0.1
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
#: Texts, and letters, that are looked at together; words whose terms are remembered; counts in a row.
TEXTS, LETTERS = 64, 1 << 21
REMEMBERED = 1 << 19
COUNTS = 4096

#: Of UTF-8: A-Z in lower case; what is ASCII and no letter becomes a blank.
SPELL = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in LOWER_BYTES)


def words_of(text: str) -> list[str]:
    return [w.decode() for w in spelled(text) if w]


def spelled(text: str) -> list[bytes]:
    """The words in UTF-8, and empty ones between neighbouring blanks."""
    return text.encode().translate(SPELL).split(b" ")


def terms_of(word: str) -> list[str]:
    """The word, and its beginnings with a star that no word has."""
    return [word, *[f"{word[:n]}*" for n in BEGINNINGS if len(word) > n]]


def _example_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic, clean): in how many of the task's examples of either label each term occurs."""
    seen = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(pc.fill_null(batch.column(0), "").to_pylist(), batch.column(1).to_pylist()):
            seen[toxic].update({t for w in set(words_of(text)) for t in terms_of(w)})
    terms = list(seen[0].keys() | seen[1].keys())
    for begin in range(0, len(terms), 100_000):
        part = terms[begin : begin + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.string()), pa.array([seen[1][t] for t in part], pa.int64()), pa.array([seen[0][t] for t in part], pa.int64())],
            ["term", "toxic", "clean"],
        )


class FirstTerms(dict):
    """The number of the first term of each word met, by ``find``."""

    def __init__(self, find: Callable[[bytes], int]) -> None:
        self.find = find

    def __missing__(self, word: bytes) -> int:
        found = self.find(word)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found
        return found


class Terms:
    """Numbers of terms, and the counts of texts by them. A word's first known term tells its others: ``after`` has the
    next one of each term, -1 for none."""

    def __init__(self, numbers: dict[str, int]) -> None:
        self.numbers, self.known = numbers, FirstTerms(self.first_of)
        self.after = np.full(len(numbers), -1, dtype=np.int64)

    def first_of(self, word: bytes) -> int:
        found = [n for t in terms_of(word.decode()) if (n := self.numbers.get(t)) is not None]
        for n, after in zip(found, found[1:]):
            self.after[n] = after
        return found[0] if found else -1

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the text, term, count), in order of both."""
        size = max(1, len(self.numbers))
        words = [spelled(text) for text in texts]
        lengths = [len(w) for w in words]
        terms = np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), np.int64, sum(lengths))
        begin = np.repeat(np.arange(len(texts)) * size, lengths)
        found = []
        while len(terms):
            met = terms >= 0
            begin, terms = begin[met], terms[met]
            found.append(begin + terms)
            terms = self.after[terms]
        keys = np.sort(np.concatenate([np.zeros(0, dtype=np.int64), *found]))
        firsts = np.flatnonzero(np.diff(keys, prepend=-1))
        counts = np.diff(np.append(firsts, len(keys)))
        keys = keys[firsts]
        return keys // size, keys % size, counts.astype(float)


@lru_cache(maxsize=1)
def terms_by(sent: Broadcast) -> Terms:
    """One for all tasks of a worker, so that they share the words met."""
    return Terms(sent.value)


def bounded(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts, with the place of their first, of a bounded number of letters or one text."""
    begin, letters = 0, 0
    for end, text in enumerate(texts):
        if end > begin and (end - begin == TEXTS or letters + len(text) > LETTERS):
            yield begin, texts[begin:end]
            begin, letters = end, 0
        letters += len(text)
    if texts:
        yield begin, texts[begin:]


def _document_counts(terms, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, counts): in how many of the task's documents each term occurs, part by part; part -1 has their number."""
    known = terms_by(terms)
    sums, rows = np.zeros(len(known.numbers), dtype=np.int64), 0
    for batch in batches:
        rows += batch.num_rows
        for _, texts in bounded(pc.fill_null(batch.column(0), "").to_pylist()):
            sums += np.bincount(known.counts(texts)[1], minlength=len(sums))
    parts = [(-1, np.array([rows]))] + [(b // COUNTS, sums[b : b + COUNTS]) for b in range(0, len(sums), COUNTS)]
    parts = [(p, zlib.compress(s.astype("<i8").tobytes(), 1)) for p, s in parts if s.any()]
    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in parts], pa.int32()), pa.array([s for _, s in parts], pa.binary())], ["part", "counts"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of each part, from rows in order of parts."""
    at, sums = None, None
    done: list[tuple[int, bytes]] = []
    for batch in batches:
        for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts = np.frombuffer(zlib.decompress(packed), dtype="<i8")
            if part == at:
                sums = sums + counts
                continue
            if at is not None:
                done.append((at, sums.tobytes()))
            at, sums = part, counts
    if at is not None:
        done.append((at, sums.tobytes()))
    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.int32()), pa.array([s for _, s in done], pa.binary())], ["part", "counts"])


def _vectors(terms, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, toxic, terms, counts) of examples (doc_id, toxic, text)."""
    known = terms_by(terms)
    for batch in batches:
        numbers, counts = [], []
        for text in pc.fill_null(batch.column(2), "").to_pylist():
            _, found, times = known.counts([text])
            numbers.append(found.tolist())
            counts.append(times.astype(np.int64).tolist())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(numbers, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
            ["doc_id", "toxic", "terms", "counts"],
        )


def relevance(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """The squared distance of a term's shrunken share of toxic examples from the common one, in log-odds."""
    share = n_toxic / (n_toxic + n_clean)
    own = (toxic + SEEN_BEFORE * share) / (toxic + clean + SEEN_BEFORE)
    away = np.log(own / (1 - own)) - math.log(share / (1 - share))
    # What is away by rounding alone is not away.
    return np.where(np.abs(away) > 1e-9, away, 0.0) ** 2


def runs_of(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, so many as its length, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    """Of each row; 0 where that is negative or there are fewer."""
    if values.shape[1] < k:
        return np.zeros(len(values))
    return np.maximum(np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k], 0.0)


class ExampleIndex:
    """Entries (terms, counts, examples, toxic examples, an example's id) under ``weights`` of the terms. Terms that many
    entries have are rows of a matrix; the others have postings."""

    def __init__(self, weights: np.ndarray, entries: list[tuple[tuple[int, ...], tuple[int, ...], int, int, object]]) -> None:
        self.weights = weights
        examples, toxic = sum(e[2] for e in entries), sum(e[3] for e in entries)
        self.prior = min(MOST_PRIOR, (toxic + 0.1) / (examples + 1.0))
        #: The score of a text without terms: a pinch of doubt.
        self.without = 0.1 / (examples + 1.0)
        vectors = []
        for terms, counts, *rest in entries:
            terms = np.array(terms, dtype=np.int64)
            raw = (1 + np.log(np.array(counts, dtype=float))) * weights[terms] if len(terms) else np.zeros(0)
            if raw.any():
                used = raw > 0
                terms, raw = terms[used], raw[used] / math.sqrt(float(raw @ raw))
                # Entries with the same strongest terms are neighbours.
                strongest = terms[np.lexsort((terms, -np.round(raw, 9)))[:3]].tolist()
                vectors.append((strongest, terms.tolist(), raw, *rest))
        vectors.sort(key=lambda v: (v[0], v[1], v[2].tolist()))
        self.size = len(vectors)
        self.n = np.array([v[3] for v in vectors], dtype=float)
        self.toxic = np.array([v[4] for v in vectors], dtype=float)
        self.ids = [v[5] for v in vectors]
        # The vectors one after another.
        self.vector_starts = np.concatenate([[0], np.cumsum([len(v[1]) for v in vectors])]).astype(np.int64)
        self.vector_terms = np.concatenate([np.zeros(0, dtype=np.int64), *[np.array(v[1]) for v in vectors]]).astype(np.int64)
        self.vector_values = np.concatenate([np.zeros(0), *[v[2] for v in vectors]])
        # The matrix has the most frequent terms, as many as are frequent and fit.
        has = np.bincount(self.vector_terms, minlength=len(weights))
        often = np.argsort(-has, kind="stable")[: min(int((has * FREQUENT > self.size).sum()), MOST_CELLS // max(1, self.size))]
        self.row = np.full(len(weights), -1, dtype=np.int32)
        self.row[often] = np.arange(len(often))
        self.rows = len(often)
        #: How far a sum may lie from the exact one, as a part of it: nothing is negative, so errors of rounding do not grow.
        self.error = (self.rows + 1024) * 2.0**-23
        # The postings of the other terms in order of entries.
        owner = np.repeat(np.arange(self.size), np.diff(self.vector_starts))
        others = np.flatnonzero(self.row[self.vector_terms] < 0)
        others = others[np.argsort(self.vector_terms[others], kind="stable")]
        self.entries, self.values = owner[others].astype(np.int32), self.vector_values[others]
        self.starts = np.concatenate([[0], np.cumsum(np.where(self.row < 0, has, 0))]).astype(np.int64)

    @cached_property
    def matrix(self) -> np.ndarray:
        """The weights of the frequent terms in the entries, made where it is used."""
        rows = self.row[self.vector_terms]
        owner = np.repeat(np.arange(self.size), np.diff(self.vector_starts))
        matrix = np.zeros((self.rows, self.size), dtype=np.float32)
        matrix[rows[rows >= 0], owner[rows >= 0]] = self.vector_values[rows >= 0]
        return matrix

    def nearest(self, place: np.ndarray, terms: np.ndarray, counts: np.ndarray, n: int, k: int, light: float = LIGHT) -> list[tuple[np.ndarray, np.ndarray]]:
        """Numbers and cosines of the k entries with the largest positive cosine for each of ``n`` texts, whose counts come in
        order of texts; equal ones, to nine digits, go to the earlier entry."""
        none = (np.zeros(0, dtype=np.int64), np.zeros(0))
        raw = (1 + np.log(counts)) * self.weights[terms]
        used = raw > 0
        if not self.size or not used.any():
            return [none] * n
        place, terms, raw = place[used], terms[used], raw[used]
        weights = raw / np.sqrt(np.bincount(place, weights=raw * raw, minlength=n))[place]
        sums, rest = self._sums(place, terms, weights, n, k, light)
        # Whatever reaches this may be among the k best; sums that are rounded to nothing do not count.
        least = np.maximum(kth_largest(sums, k) * (1 - 2 * self.error) - rest, 1e-10)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        texts, near = np.nonzero(sums >= least[:, None])
        bounds, nears = np.searchsorted(place, np.arange(n + 1)).tolist(), np.searchsorted(texts, np.arange(n + 1)).tolist()
        scratch = np.zeros(len(self.weights))
        for text in range(n):
            likely, own = near[nears[text] : nears[text + 1]], slice(bounds[text], bounds[text + 1])
            if not len(likely):
                found.append(none)
                continue
            scratch[terms[own]] = weights[own]
            scores = np.round(self._exact(scratch, likely), 9)
            scratch[terms[own]] = 0.0
            best = np.lexsort((likely, -scores))[:k]
            best = best[scores[best] > 0]
            found.append((likely[best], scores[best]))
        return found

    def _exact(self, scratch: np.ndarray, near: np.ndarray) -> np.ndarray:
        """The cosines of some entries with the text whose weights are in ``scratch``."""
        spans = [slice(a, b) for a, b in zip(self.vector_starts[near].tolist(), self.vector_starts[near + 1].tolist())]
        return np.array([scratch.take(self.vector_terms[own]) @ self.vector_values[own] for own in spans])

    def _sums(self, place: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, k: int, light: float) -> tuple[np.ndarray, np.ndarray]:
        """The cosines of all entries with each text but for rounding and the text's light terms, and what these can add."""
        rows = self.row[terms]
        inside = rows >= 0
        texts = np.zeros((n, self.rows), dtype=np.float32)
        texts[place[inside], rows[inside]] = weights[inside]
        sums = texts @ self.matrix
        place, terms, weights = place[~inside], terms[~inside], weights[~inside]
        # The light ones of the other terms: their squares together are no more than that of ``light``.
        is_light = weights * np.sqrt(np.bincount(place, minlength=n))[place] <= light
        self._add(sums, place[~is_light], terms[~is_light], weights[~is_light])
        place, terms, weights = place[is_light], terms[is_light], weights[is_light]
        rest = np.sqrt(np.bincount(place, weights=weights**2, minlength=n)) * (1 + 1e-9)
        # Where so little is shared that light terms may decide anywhere, nothing counts as light.
        weak = (rest > 0) & (kth_largest(sums, k) * (1 - 2 * self.error) <= rest)
        if weak.any():
            rest[weak] = 0.0
            self._add(sums, place[weak[place]], terms[weak[place]], weights[weak[place]])
        return sums, rest

    def _add(self, sums: np.ndarray, place: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> None:
        """Add the products of the weights with the postings of their terms, a bounded number at a time."""
        lengths = self.starts[terms + 1] - self.starts[terms]
        cuts = np.searchsorted(np.cumsum(lengths), np.arange(POSTINGS, int(lengths.sum()) + POSTINGS, POSTINGS))
        begin = 0
        for end in np.minimum(cuts + 1, len(terms)).tolist():
            own, begin = slice(begin, end), end
            at = runs_of(self.starts[terms[own]], lengths[own])
            keys = np.repeat(place[own] * sums.shape[1], lengths[own]) + self.entries[at]
            products = np.repeat(weights[own], lengths[own]) * self.values[at]
            sums += np.bincount(keys, weights=products, minlength=sums.size).reshape(sums.shape)

    def scores(self, place: np.ndarray, terms: np.ndarray, counts: np.ndarray, n: int, k: int = NEAREST) -> list[tuple[float, list[object], list[float]]]:
        """The toxic share of the votes, and the evidence: nearest examples and their cosines."""
        out = []
        for numbers, cosines in self.nearest(place, terms, counts, n, k):
            if not len(numbers):
                out.append((self.without, [], []))
                continue
            votes = self.n[numbers] * cosines**2 / (1 - np.minimum(cosines, 1.0) + SOFTEN)
            share = self.toxic[numbers] / self.n[numbers]
            score = (float(votes @ share) + PRIOR_WEIGHT * self.prior) / (float(votes.sum()) + PRIOR_WEIGHT)
            out.append((min(1.0, max(0.0, round(score, 9))), [self.ids[i] for i in numbers], cosines.round(6).tolist()))
        return out


#: Its former name.
BlockMaxIndex = ExampleIndex


def _scores(terms, index, nearest: int, id_type: pa.DataType, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = terms_by(terms)
    for batch in batches:
        for begin, texts in bounded(pc.fill_null(batch.column(2), "").to_pylist()):
            # Repeated texts of a run are scored once.
            distinct = list(dict.fromkeys(texts))
            found = dict(zip(distinct, index.value.scores(*known.counts(distinct), len(distinct), nearest)))
            out = [found[t] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(begin, len(texts)),
                    batch.column(1).slice(begin, len(texts)),
                    pa.array([s for s, _, _ in out], pa.float64()),
                    pa.array([e for _, e, _ in out], pa.list_(id_type)),
                    pa.array([c for _, _, c in out], pa.list_(pa.float64())),
                ],
                ["doc_id", "mark", "score", "evidence", "cosines"],
            )


def examples_of(labels: DataFrame, id: str, label: str, most: int) -> DataFrame:
    """(doc_id, toxic) of at most ``most`` labelled ids outside the held-out fold, the first by a hash. An
    id with several labels is toxic if one of them says so; null ids and labels are left out."""
    known = renamed(labels, doc_id=id, toxic=label).where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    each = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    open_ = each.where(crc32_remainder(F.col("doc_id"), FOLDS) != HELD_OUT)
    return open_.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def index_of(rows: DataFrame, examples: DataFrame) -> tuple[dict[str, int], ExampleIndex]:
    """The numbers of the terms of ``examples`` (doc_id, toxic, text), and the index with document frequencies over
    ``rows`` (text)."""
    spark = rows.sparkSession
    totals = {r["toxic"]: r["n"] for r in examples.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        entries = [((), (), n, n * toxic, None) for toxic, n in totals.items()]
        return {}, ExampleIndex(np.zeros(0), entries)
    each = examples.select("text", "toxic").mapInArrow(_example_terms, "term string, toxic bigint, clean bigint")
    summed = each.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # How one example's words begin, and no other's, says no more than the words.
    met = summed.where(~F.col("term").endswith("*") | (F.col("toxic") + F.col("clean") > 1)).toArrow().sort_by("term")
    numbers = {t: n for n, t in enumerate(met.column("term").to_pylist())}
    says = relevance(met.column("toxic").to_numpy(), met.column("clean").to_numpy(), totals[1], totals[0])
    sent = spark.sparkContext.broadcast(numbers)
    counted = rows.select("text").mapInArrow(lambda batches: _document_counts(sent, batches), "part int, counts binary")
    # A row per task and part meets its like in one stream.
    parts = counted.repartition("part").sortWithinPartitions("part").mapInArrow(_summed, "part int, counts binary").collect()
    frequency, n_docs = np.zeros(len(numbers), dtype=np.int64), 0
    for part, packed in parts:
        counts = np.frombuffer(packed, dtype="<i8")
        if part < 0:
            n_docs = int(counts[0])
        else:
            frequency[part * COUNTS : part * COUNTS + len(counts)] = counts
    weights = says * (np.log((1 + n_docs) / (1 + frequency)) + 1.0)
    kind = rows.schema["doc_id"].dataType.simpleString()
    seen = examples.select("doc_id", "toxic", "text").mapInArrow(
        lambda batches: _vectors(sent, batches), f"doc_id {kind}, toxic int, terms array<int>, counts array<int>"
    )
    grouped = seen.groupBy("terms", "counts").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic"), F.min("doc_id").alias("doc_id"))
    found = [(tuple(r["terms"]), tuple(r["counts"]), r["n"], r["toxic"], r["doc_id"]) for r in grouped.toLocalIterator()]
    return numbers, ExampleIndex(weights, found)


def toxicity(
    df: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    label_id: str = "doc_id",
    most_examples: int = MOST_EXAMPLES,
    nearest: int = NEAREST,
    threshold: float = THRESHOLD,
    learn_from: DataFrame | None = None,
) -> DataFrame:
    """One row per row of ``df``: doc_id, held_out, score, predicted, evidence, cosines, mark.

    Labels are used of at most ``most_examples`` documents whose crc32(id) mod 4 is not 2; their texts come
    from ``learn_from`` (default: ``df``), and of several texts of one id the first by hash. A text that shares no term with
    the examples, or only such that occur in toxic and clean examples at exactly the common rate, has no evidence
    against it, null and empty ones too: whatever the labels' shares, its score is 0.1 / (examples + 1). Without labels, or with labels
    of one kind only, that holds for all texts. An empty table gives no rows. Rows are scored alone, so repeated rows score alike. ``evidence``
    has the ids of the nearest examples, one per distinct vector, with their ``cosines``; ties go to the entry first in order
    of its terms. ``mark`` (xxhash64 of the text) tells rows of one id apart. Jobs run when this is called; to the driver come
    the terms and vectors of the examples.
    """
    spark = df.sparkSession
    rows = renamed(df, doc_id=id, text=text)
    texts = rows if learn_from is None else renamed(learn_from, doc_id=id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    id_type = pa.string() if kind == "string" else pa.int64() if kind == "bigint" else pa.int32()
    chosen = stage(examples_of(labels, label_id, label, most_examples), "examples")
    # At most ``most_examples`` rows of an id and a label.
    known = texts.where(F.col("doc_id").isNotNull()).join(F.broadcast(chosen), "doc_id")
    known = known.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    numbers, index = index_of(rows, stage(known, "example-texts"))
    terms, found = spark.sparkContext.broadcast(numbers), spark.sparkContext.broadcast(index)
    scored = rows.select("doc_id", F.xxhash64("text").alias("mark"), "text").mapInArrow(
        lambda batches: _scores(terms, found, nearest, id_type, batches),
        f"doc_id {kind}, mark bigint, score double, evidence array<{kind}>, cosines array<double>",
    )
    held_out = F.col("doc_id").isNotNull() & (crc32_remainder(F.col("doc_id"), FOLDS) == HELD_OUT)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence", "cosines", "mark"
    )


def clean(df: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``df`` that are not predicted toxic, with their columns."""
    bad = toxicity(df, labels, id, text, **how).where(F.col("predicted") == 1)
    named = bad.select(F.col("doc_id").alias("doc_id_"), F.col("mark").alias("mark_")).distinct()
    return df.join(named, df[f"`{id}`"].eqNullSafe(named["doc_id_"]) & (F.xxhash64(df[f"`{text}`"]) == named["mark_"]), "left_anti")
