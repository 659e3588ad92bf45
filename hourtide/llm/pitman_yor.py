"""A hierarchical Pitman-Yor language model, trained and applied by Spark.

Every word of the training texts is a customer in the restaurant of its context, the word before it. All
context restaurants share one parent, the restaurant of single words: each of their tables is a customer
there. Above it stands the even distribution over the known words and one unknown one. Seatings are drawn
by Gibbs sweeps; several are kept, and a word's probability is the mean of its predictive probabilities
under them.

What is computed depends on numbers of customers and tables per (context, word) only. So the texts are
cut into blocks of a bounded number of words, each with its own sorted vocabulary, and everything else
travels as compressed arrays between blocks and buckets, in the order of the block's own list, so that
answers need no keys:

1. texts -> blocks: word numbers per text, hashes and training counts of the block's words (one table);
2. words by hash: counts over all blocks, a number for each known word, answers to the blocks;
3. word pairs by context: counts over all blocks, seatings of the contexts, answers to the blocks, and
   tables per word for the parent. A context with more than a thousandth of all customers (there are at
   most a thousand) is spread over all buckets by its words; a bucket then takes the context's tables to
   be in proportion to its share of the customers;
4. the parent's customers by word: their seating, answers to the blocks;
5. blocks: probabilities of their texts.

One sweep removes every customer and seats them again by the predictive rule: at a new table with weight
(strength + discount * tables of the restaurant) * the parent's probability, else at one of the dish's own
tables. Which tables are left empty follows from the number of tables with one customer, given the dish's
customers and tables. Dishes are swept in parallel, and of dishes with over eight customers an eighth at a
time. The parent's probabilities while contexts are seated are those of the word counts.

Every table written in between grows in proportion to the texts. Totals (words, distinct words, tables of
the most frequent contexts) are all that reaches the driver.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourtide.llm.common import LOWER_BYTES, crc32_remainder, renamed
from hourtide.session import checkpoint_folder

FOLDS, HELD_OUT = 10, 0
SAMPLES, BURN_IN = 3, 3
SEED = 11
#: Discount and strength of the context restaurants and of their parent.
CONTEXT_LAW = (0.75, 2.0)
PARENT_LAW = (0.6, 20.0)
#: A context with more than this share of all customers is spread over the buckets.
HOT_SHARE = 1 / 1000
BLOCK_TOKENS = 1 << 20
BUCKET_ENTRIES = 1 << 21
#: Parts in which the customers of a dish are seated again.
ROUNDS = 8
#: No word is spelled as a blank, so its hash stands for the end of a text.
END = b" "
#: The number of the context at the beginning of a text.
BEGIN = (1 << 32) - 1
UNKNOWN = -1


# --- arrays in transit ------------------------------------------------------------------------------


def pack(values: np.ndarray, ascending: bool = False) -> bytes:
    """Unsigned integers as compressed byte planes of the width they need; differences if ascending."""
    values = np.ascontiguousarray(values, dtype="<u8")
    if ascending and len(values):
        values = np.concatenate([values[:1], np.diff(values)])
    width = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 1
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return struct.pack("<QB?", len(values), width, ascending) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    n, width, ascending = struct.unpack_from("<QB?", data)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[10:], max_output_size=max(1, n * width)), dtype=np.uint8)
    wide = np.zeros((n, 8), dtype=np.uint8)
    wide[:, :width] = planes.reshape(width, n).T
    values = wide.reshape(-1).view("<u8").astype(np.int64) if not ascending else np.cumsum(wide.reshape(-1).view("<u8"), dtype=np.uint64)
    return values.view(np.int64) if not ascending else values


def cut(array: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    return [array[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


RECORD = "kind string, block bigint, bucket int, data array<binary>"


def records(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["kind", "block", "bucket", "data"])


def joined(pdf: pd.DataFrame, kind: str) -> list[np.ndarray]:
    """The arrays of all buckets of a kind, each joined in the order of the buckets."""
    parts = [[unpack(x) for x in data] for data in pdf[pdf["kind"] == kind].sort_values("bucket")["data"]]
    return [np.concatenate(column) for column in zip(*parts)]


# --- seating ----------------------------------------------------------------------------------------


def single_tables(discount: float) -> tuple[np.ndarray, np.ndarray]:
    """(logarithm of the mean table size, share of tables with one customer) for ascending sizes.

    Given their number, the tables of a dish are as independent draws of a size with generating function
    1 - (1 - z) ** discount, at the z that gives the mean size: the saddle point of the Stirling numbers.
    """
    a = np.geomspace(1e-6, 200, 2000)
    phi, z = -np.expm1(-a * discount), -np.expm1(-a)
    return np.log(discount * z / phi) + a * (1 - discount), discount * z / phi


def sweep(customers, tables, fixed, restaurant, share, parent, law, rng, singles) -> np.ndarray:
    """Remove and seat again every customer of dishes with two or more, an eighth of a dish's at a time (one
    by one for the first eight). A customer who leaves takes the table along if alone there."""
    discount, strength = law
    for _ in range(ROUNDS):
        leaving = -(-customers // ROUNDS)
        whole = ((np.bincount(restaurant, weights=tables, minlength=len(share)) + fixed) / share)[restaurant]
        alone = tables * np.interp(np.log(customers / tables), *singles)
        alone = np.minimum(alone, np.where(tables < customers, tables - 1, tables)) / customers
        lost = np.minimum(rng.binomial(leaving, np.clip(alone, 0, 1)), tables - 1)
        left = np.minimum(tables - lost, customers - leaving)
        # Those who sit down later find the earlier ones seated: half of them on average.
        half, opened = (leaving - 1) / 2, 0.0
        for _ in range(2):
            new = np.maximum(strength + discount * (whole - tables + left + opened), 0) * parent
            joined = np.maximum(customers - leaving + half - discount * (left + opened), 0)
            chance = new / np.maximum(new + joined, 1e-300)
            opened = half * chance
        tables = left + rng.binomial(leaving, np.clip(chance, 0, 1))
    return tables


def seatings(customers: np.ndarray, restaurant: np.ndarray, share: np.ndarray, parent: np.ndarray, law, rng, samples: int, burn_in: int):
    """(tables, tables per restaurant) of each kept sweep. ``restaurant`` numbers each dish's restaurant,
    ``share`` is the part of its customers that is here; ``parent`` is the dish's probability above."""
    n, several = len(share), np.flatnonzero(customers > 1)
    tables, kept = (customers > 0).astype(np.int64), []
    # A dish with one customer has one table, whatever else is drawn.
    fixed = np.bincount(restaurant, weights=customers == 1, minlength=n)
    singles = single_tables(law[0])
    own = tables[several]
    for number in range(burn_in + samples):
        own = sweep(customers[several], own, fixed, restaurant[several], share, parent[several], law, rng, singles)
        if number >= burn_in:
            tables = tables.copy()
            tables[several] = own
            kept.append((tables, np.bincount(restaurant, weights=tables, minlength=n)))
    return kept


# --- 1. texts to blocks -----------------------------------------------------------------------------


class Numbers(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _blocks(block_tokens: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId() << 24
    numbers, ids, train, texts = Numbers({END: 0}), [], [], []
    held = 0

    def out() -> pa.RecordBatch:
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in numbers], dtype=np.uint64)
        order = np.argsort(hashes, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        lengths = np.array([len(t) for t in texts])
        tokens = place[np.concatenate(texts)]
        learned = np.repeat(np.array(train), lengths)
        counts = np.bincount(tokens[learned], minlength=len(order))
        arrays = [pack(tokens), pack(lengths), pack(np.array(train)), pack(hashes[order], True), pack(counts)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block], pa.int64()),
                pa.array([ids], pa.list_(id_type)),
                pa.array([arrays], pa.list_(pa.binary())),
                pa.array([len(tokens)], pa.int64()),
                pa.array([int(learned.sum())], pa.int64()),
                pa.array([len(order)], pa.int64()),
                pa.array([int(sum(train))], pa.int64()),
            ],
            ["block", "ids", "data", "n_tokens", "n_train", "n_words", "n_texts"],
        )

    for batch in batches:
        id_type = batch.column(0).type
        texts_in = pc.fill_null(batch.column(1), "").cast(pa.binary()).to_pylist()
        for doc_id, text, learn in zip(batch.column(0).to_pylist(), texts_in, batch.column(2).to_pylist()):
            words = list(map(numbers.__getitem__, text.translate(LOWER_BYTES).split()))
            words.append(0)
            ids.append(doc_id)
            train.append(learn)
            texts.append(np.array(words, dtype=np.int32))
            held += len(words)
            if held >= block_tokens:
                yield out()
                block += 1
                numbers, ids, train, texts, held = Numbers({END: 0}), [], [], [], 0
    if ids:
        yield out()


# --- 2. words ---------------------------------------------------------------------------------------


def _word_requests(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut each block's sorted hashes at the buckets' bounds."""
    step = -(-(1 << 64) // buckets)
    bounds = np.array([min(i * step, (1 << 64) - 1) for i in range(1, buckets)], dtype=np.uint64)
    for batch in batches:
        for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            hashes, counts = unpack(data[3]), unpack(data[4])
            at = np.concatenate([[0], np.searchsorted(hashes, bounds), [len(hashes)]])
            rows = [(b, [pack(h, True), pack(c)]) for b, (h, c) in enumerate(zip(cut(hashes, at), cut(counts, at)))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(["request"] * len(rows)),
                    pa.array([block] * len(rows), pa.int64()),
                    pa.array([b for b, _ in rows], pa.int32()),
                    pa.array([d for _, d in rows], pa.list_(pa.binary())),
                ],
                ["kind", "block", "bucket", "data"],
            )


def _count_words(buckets: int, n_train: int, hot_share: float, pdf: pd.DataFrame) -> pd.DataFrame:
    """Answers (number + 1 or 0, count) to the blocks, the bucket's known words, and frequent contexts."""
    bucket = int(pdf["bucket"].iloc[0])
    asked = [(block, *map(unpack, data)) for block, data in zip(pdf["block"], pdf["data"])]
    hashes, where = np.unique(np.concatenate([h for _, h, _ in asked]), return_inverse=True)
    counts = np.bincount(where, weights=np.concatenate([c for _, _, c in asked]), minlength=len(hashes)).astype(np.int64)
    numbers = np.where(counts > 0, (np.cumsum(counts > 0) - 1) * buckets + bucket, UNKNOWN)
    if len(numbers) and numbers.max() >= BEGIN:
        raise ValueError("more known words than 32 bits can number")
    rows, at = [], 0
    for block, h, _ in asked:
        own = where[at : at + len(h)]
        rows.append(("word", block, bucket, [pack(numbers[own] + 1), pack(counts[own])]))
        at += len(h)
    often = np.flatnonzero(counts > hot_share * n_train)
    rows.append(("known", 0, bucket, [pack(np.array([(counts > 0).sum()]))]))
    rows.append(("often", 0, bucket, [pack(numbers[often]), pack(counts[often])]))
    return records(rows)


# --- 3. word pairs ----------------------------------------------------------------------------------


def spread(keys: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a pair: its context's, or its own if the context is frequent."""
    context = keys >> np.uint64(32)
    mixed = np.where(np.isin(context, hot), keys, context) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


class Block:
    """A block's texts with the numbers and counts of its words, and its distinct pairs in the order of
    (bucket, context, word), which later answers follow."""

    def __init__(self, pdf: pd.DataFrame, hot: np.ndarray, buckets: int) -> None:
        texts = pdf[pdf["kind"] == "texts"].iloc[0]
        self.tokens, self.lengths, train = (unpack(x) for x in texts["data"][:3])
        self.number, self.count = joined(pdf, "word")
        self.number = self.number - 1
        ends = np.cumsum(self.lengths)
        self.starts = ends - self.lengths
        self.learned = np.repeat(train > 0, self.lengths)
        number = self.number[self.tokens]
        before = np.empty_like(number)
        before[1:] = number[:-1]
        before[self.starts] = BEGIN
        self.context = before
        #: Customers of each token's context restaurant; that of the beginning is filled in later.
        known_before = np.zeros(len(number), dtype=np.int64)
        known_before[1:] = self.count[self.tokens[:-1]]
        known_before[self.starts] = 0
        self.context_count = known_before
        self.paired = np.flatnonzero((number >= 0) & (before >= 0))
        keys = before[self.paired].astype(np.uint64) << np.uint64(32) | number[self.paired].astype(np.uint64)
        unique, self.pair = np.unique(keys, return_inverse=True)
        bucket = spread(unique, hot, buckets)
        order = np.lexsort((unique, bucket))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.pair = place[self.pair]
        self.keys = unique[order]
        self.bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
        self.customers = np.bincount(self.pair[self.learned[self.paired]], minlength=len(order))


def _pair_requests(hot: np.ndarray, buckets: int, n_train: int, pdf: pd.DataFrame) -> pd.DataFrame:
    block = Block(pdf, hot, buckets)
    # The word's share of all words, in eighths of powers of two: good enough to draw tables by.
    rare = np.clip(np.round(-8 * np.log2(np.maximum(block.count, 1) / max(1, n_train))), 0, 255)
    code = np.zeros(len(block.keys), dtype=np.int64)
    code[block.pair] = rare[block.tokens[block.paired]]
    rows = []
    for b, (k, c, r) in enumerate(zip(cut(block.keys, block.bounds), cut(block.customers, block.bounds), cut(code, block.bounds))):
        if len(k):
            rows.append(("request", pdf["block"].iloc[0], b, [pack(k, True), pack(c), pack(r)]))
    return records(rows)


def _seat_contexts(hot: dict[int, int], word_buckets: int, law, samples: int, burn_in: int, seed: int, pdf: pd.DataFrame) -> pd.DataFrame:
    bucket = int(pdf["bucket"].iloc[0])
    asked = [(block, *map(unpack, data)) for block, data in sorted(zip(pdf["block"], pdf["data"]), key=lambda x: x[0])]
    keys, first, where = np.unique(np.concatenate([a[1] for a in asked]), return_index=True, return_inverse=True)
    customers = np.bincount(where, weights=np.concatenate([a[2] for a in asked]), minlength=len(keys)).astype(np.int64)
    parent = 2.0 ** (-np.concatenate([a[3] for a in asked])[first] / 8)
    contexts, restaurant = np.unique(keys >> np.uint64(32), return_inverse=True)
    here = np.bincount(restaurant, weights=customers, minlength=len(contexts))
    whole = np.array([hot.get(int(c), 0) for c in contexts.tolist()], dtype=float)
    share = np.where((whole > 0) & (here > 0), here / np.maximum(whole, 1), 1.0)
    rng = np.random.default_rng([seed, bucket])
    kept = seatings(customers, restaurant, share, parent, law, rng, samples, burn_in)
    rows, at = [], 0
    for block, k, *_ in asked:
        own = where[at : at + len(k)]
        at += len(k)
        there = np.unique(restaurant[own])
        data = [pack(customers[own])] + [pack(t[own]) for t, _ in kept] + [pack(per[there]) for _, per in kept]
        rows.append(("seats", block, bucket, data))
    often = np.flatnonzero(whole > 0)
    if len(often):
        rows.append(("frequent", 0, bucket, [pack(contexts[often])] + [pack(per[often]) for _, per in kept]))
    words, dish = np.unique((keys & np.uint64(BEGIN)).astype(np.int64), return_inverse=True)
    sums = [np.bincount(dish, weights=t, minlength=len(words)).astype(np.int64) for t, _ in kept]
    home = words % word_buckets
    for b in np.unique(home).tolist():
        own = home == b
        rows.append(("tables", 0, b, [pack(words[own] // word_buckets, True)] + [pack(s[own]) for s in sums]))
    return records(rows)


# --- 4. the parent ----------------------------------------------------------------------------------


def _seat_parent(totals: list[int], n_words: int, word_buckets: int, law, samples: int, burn_in: int, seed: int, pdf: pd.DataFrame) -> pd.DataFrame:
    """Answers (customers and tables of each kept seating) to the blocks, and the bucket's tables."""
    bucket = int(pdf["bucket"].iloc[0])
    tables = [list(map(unpack, data)) for data in pdf[pdf["kind"] == "tables"]["data"]]
    words = pdf[pdf["kind"] == "word"]
    numbers = {block: unpack(data[0]) for block, data in zip(words["block"], words["data"])}
    n = 1 + max([int(t[0].max()) for t in tables if len(t[0])] + [int(x.max() - 1) // word_buckets for x in numbers.values() if len(x)] + [-1])
    rng = np.random.default_rng([seed, 1, bucket])
    customers, seated = [], []
    for s in range(samples):
        guests = np.zeros(n, dtype=np.int64)
        for t in tables:
            guests[t[0].astype(np.int64)] += t[1 + s]
        share = np.array([guests.sum() / max(1, totals[s]) or 1.0])
        at = np.zeros(n, dtype=np.int64)
        last = seatings(guests, at, share, np.full(n, 1 / (n_words + 1)), law, rng, 1, burn_in)[0]
        customers.append(guests)
        seated.append(last[0])
    rows = []
    for block, own in numbers.items():
        at, known = np.maximum(own - 1, 0) // word_buckets, own > 0
        rows.append(("parent", block, bucket, [pack(np.where(known, x[at] if n else 0, 0)) for x in customers + seated]))
    rows.append(("root", 0, bucket, [pack(np.array([t.sum()])) for t in seated]))
    return records(rows)


# --- 5. texts ---------------------------------------------------------------------------------------


def _score(hot: dict[int, int], hot_tables: dict[int, list[int]], buckets: int, n_train: int, n_words: int, totals, roots, laws, pdf: pd.DataFrame):
    block = Block(pdf, np.array(sorted(hot), dtype=np.uint64), buckets)
    samples = len(totals)
    (d, s), (d1, s1) = laws
    count = block.count[block.tokens]
    base = np.log10((count + 0.1) / (n_train + 0.1 * (n_words + 1)))
    above = joined(pdf, "parent")
    customers = np.zeros(len(block.keys), dtype=np.int64)
    tables = np.zeros((samples, len(block.keys)))
    per_context = np.zeros((samples, len(block.keys)))
    for bucket, data in zip(*(pdf[pdf["kind"] == "seats"][c] for c in ("bucket", "data"))):
        part = slice(block.bounds[bucket], block.bounds[bucket + 1])
        arrays = [unpack(x) for x in data]
        customers[part] = arrays[0]
        _, own = np.unique(block.keys[part] >> np.uint64(32), return_inverse=True)
        for i in range(samples):
            tables[i, part] = arrays[1 + i]
            per_context[i, part] = arrays[1 + samples + i][own]
    contexts = block.keys >> np.uint64(32)
    for context in np.intersect1d(contexts, np.array(sorted(hot_tables), dtype=np.uint64)).tolist():
        for i in range(samples):
            per_context[i, contexts == context] = hot_tables[context][i]
    guests = block.context_count.copy()
    guests[block.context == BEGIN] = hot.get(BEGIN, 0)
    guests[block.context < 0] = 0
    # A context's tables are known where one of its pairs is; a known context before an unknown word has
    # them from the same block's other pairs, or else as if each of its customers had a table.
    known_tables = dict()
    total = np.zeros(len(block.tokens))
    for i in range(samples):
        parent = (np.maximum(above[i] - d1 * above[samples + i], 0) + (s1 + d1 * roots[i]) / (n_words + 1)) / (s1 + totals[i])
        p = parent[block.tokens]
        context_tables = guests.astype(float)
        context_tables[block.paired] = per_context[i][block.pair]
        lone = np.flatnonzero((guests > 0) & (block.number[block.tokens] < 0))
        if len(lone):
            first = np.unique(contexts, return_index=True)
            known_tables = dict(zip(first[0].tolist(), per_context[i][first[1]].tolist()))
            context_tables[lone] = [known_tables.get(c, g) for c, g in zip(block.context[lone].tolist(), guests[lone].tolist())]
        seen = np.zeros(len(block.tokens))
        seen[block.paired] = np.maximum(customers - d * tables[i], 0)[block.pair]
        total += np.where(guests > 0, (seen + (s + d * context_tables) * p) / (s + guests), p)
    logs = np.log10(total / samples)
    texts = pdf[pdf["kind"] == "texts"].iloc[0]
    return pd.DataFrame(
        {
            "doc_id": pd.Series(list(texts["ids"])),
            "n_tokens": block.lengths,
            "n_known": np.add.reduceat((count > 0).astype(np.int64), block.starts),
            "base_score": np.add.reduceat(base, block.starts),
            "score": np.add.reduceat(logs, block.starts),
        }
    )


# --- the whole --------------------------------------------------------------------------------------


def _by_kind(df: DataFrame, name: str):
    """Write records with a folder per kind; returns a reader of one kind."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/stages/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy("kind").parquet(path)
    shape = "block bigint, bucket int, data array<binary>"

    def read(kind: str) -> DataFrame:
        return spark.read.schema(f"kind string, {shape}").parquet(path).where(F.col("kind") == kind).select("kind", "block", "bucket", "data")

    return read


def lm_scores(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    samples: int = SAMPLES,
    burn_in: int = BURN_IN,
    context_law: tuple[float, float] = CONTEXT_LAW,
    parent_law: tuple[float, float] = PARENT_LAW,
    hot_share: float = HOT_SHARE,
    block_tokens: int = BLOCK_TOKENS,
    bucket_entries: int = BUCKET_ENTRIES,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``df``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Texts whose crc32(id) mod 10 is 0 are held out; all others are learned from, a missing id counting as
    held out. Tokens are the words and one end per text, so a null or empty text is one token. ``score`` is
    the log10 probability of the text, ``perplexity`` follows as 10 ** (-score / n_tokens). Words never
    learned share one unknown word's probability; after an unknown word the parent alone decides. If
    nothing is learned every word is unknown and has the even probability 1. Repeated rows are learned
    from each time and score alike. An empty table gives no rows. A text is held whole by one task. Runs
    jobs when called; their tables stay in the shared folder.
    """
    rows = renamed(df, doc_id=id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    spark = df.sparkSession
    learn = crc32_remainder(F.col("doc_id"), FOLDS) != HELD_OUT
    shape = f"block bigint, ids array<{kind}>, data array<binary>, n_tokens bigint, n_train bigint, n_words bigint, n_texts bigint"
    cut_up = rows.select("doc_id", "text", learn.alias("learn")).mapInArrow(with_args(_blocks, block_tokens), shape)
    path = f"{checkpoint_folder(spark)}/stages/{spark.sparkContext.applicationId}/blocks-{uuid.uuid4().hex}"
    cut_up.write.parquet(path)
    blocks = spark.read.schema(shape).parquet(path)
    sums = blocks.agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_train", "n_words", "n_texts")]).first()
    n_train, n_texts = sums["n_train"] or 0, sums["n_texts"] or 0
    word_buckets = 1 + (sums["n_words"] or 0) // bucket_entries
    buckets = 1 + (sums["n_tokens"] or 0) // bucket_entries

    asked = blocks.select("block", "data").mapInArrow(with_args(_word_requests, word_buckets), RECORD)
    words = _by_kind(asked.groupBy("bucket").applyInPandas(with_args(_count_words, word_buckets, n_train, hot_share), RECORD), "words")
    n_words = added(words("known"), 1)[0]
    # Fewer than 1 / hot_share words can each have more than this share.
    hot = {r["c0"]: r["c1"] for r in numbers_of(words("often"), 2).collect()} | {BEGIN: n_texts}
    hot_keys = np.array(sorted(hot), dtype=np.uint64)

    # Hashes and counts have done their work: the answers stand in for them.
    kept = F.slice("data", 1, 3).alias("data")
    texts = blocks.select(F.lit("texts").alias("kind"), "block", F.lit(0).alias("bucket"), kept, "ids")
    no_ids = F.lit(None).cast(f"array<{kind}>").alias("ids")
    with_words = texts.unionByName(words("word").select("*", no_ids))
    pairs = with_words.groupBy("block").applyInPandas(with_args(_pair_requests, hot_keys, buckets, n_train), RECORD)
    seat_all = with_args(_seat_contexts, hot, word_buckets, context_law, samples, burn_in, seed)
    seats = _by_kind(pairs.groupBy("bucket").applyInPandas(seat_all, RECORD), "seats")
    per_hot = numbers_of(seats("frequent"), 1 + samples).groupBy("c0").agg(*[F.sum(f"c{1 + i}").alias(f"s{i}") for i in range(samples)])
    hot_tables = {c: [0] * samples for c in hot} | {r["c0"]: [r[f"s{i}"] for i in range(samples)] for r in per_hot.collect()}

    totals = added(seats("tables"), 1 + samples)[1:]
    at_parent = seats("tables").unionByName(words("word"))
    seat_up = with_args(_seat_parent, totals, n_words, word_buckets, parent_law, samples, burn_in, seed)
    parents = _by_kind(at_parent.groupBy("bucket").applyInPandas(seat_up, RECORD), "parents")
    roots = added(parents("root"), samples)

    answers = with_words.unionByName(seats("seats").select("*", no_ids)).unionByName(parents("parent").select("*", no_ids))
    score = with_args(_score, hot, hot_tables, buckets, n_train, n_words, totals, roots, (context_law, parent_law))
    scored = answers.groupBy("block").applyInPandas(score, f"doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double")
    held_out = crc32_remainder(F.col("doc_id"), FOLDS) == HELD_OUT
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(n_train).cast("bigint").alias("train_tokens"), "base_score", "score"
    )


def with_args(apply: Callable, *args) -> Callable:
    """``apply`` with its leading arguments given, as a plain function of one argument."""
    return lambda data: apply(*args, data)


def _numbers(columns: int, sums: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The arrays of each record as columns, or their sums."""
    for batch in batches:
        for data in batch.column(0).to_pylist():
            arrays = [unpack(x).astype(np.int64) for x in data]
            values = [[int(a.sum())] for a in arrays] if sums else arrays
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in values], [f"c{i}" for i in range(columns)])


def numbers_of(rows: DataFrame, columns: int, sums: bool = False) -> DataFrame:
    shape = ", ".join(f"c{i} bigint" for i in range(columns))
    return rows.select("data").mapInArrow(with_args(_numbers, columns, sums), shape)


def added(rows: DataFrame, columns: int) -> list[int]:
    """The sums of the arrays of all records, one number per array."""
    row = numbers_of(rows, columns, True).agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(columns)]).first()
    return [int(x or 0) for x in row]
