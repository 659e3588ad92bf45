"""Sequences of one length by cutting-stock column generation.

1. A map task encodes its documents and cuts them every ``room`` tokens: whole pieces are sequences of their own,
   and the tails are dealt to classes of lengths. Each task numbers its tails within their class.
2. The histogram of the classes, whose size does not depend on the data, is a linear program over patterns
   (how many tails of each class one sequence takes). Columns are generated: the program's prices go into a knapsack
   by dynamic programming, and its best pattern comes in, until the bound it gives shows that no pattern saves more.
3. Patterns are taken as often as their rounded-down shares; the few tails of each class that remain are put
   together by best fit decreasing. A tail's rank in its class, from the tasks' counts, tells its pattern, the
   sequence and its place there: no tail has to meet another to be placed.
4. Sequences that would need more than a little padding are cut at powers of two, which need none.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from hourtide.llm.common import renamed, stage
from hourtide.llm.packing import best_fit

ROOM = 4096
END_ID = 2
#: Classes of short lengths are so many tokens wide; a class counts as its largest length.
WIDTH = 8
#: Above these shares of the room classes are two and four times as wide: a sequence has room for few such tails.
WIDER = (1 / 8, 3 / 8)
#: The linear program ends where its value is proven to be within this share of the best.
GAP = 0.002
MOST_ROUNDS = 4000
#: A sequence may be padded by this share; others are cut at powers of two.
PADDING = 1 / 32
REMEMBERED = 1 << 19
#: Texts are encoded in parts of about so many letters.
PART = 1 << 20
#: The vocabulary cuts at white space and between letters and what is none, so that a text is the words between its
#: blanks, Latin letters and what follows them for themselves. (The letter left out becomes two when it is made small;
#: letters are not cut off from what is not ASCII, which may be a mark on the last one.)
LATIN = r"[A-Za-zÀ-ÖØ-öø-įı-ſ]+"
WORDS = re.compile(LATIN + r"+(?=[\x00-@\[-`{-\x7F]|\Z)|[^ \t\n\v\f\r]+")
LETTERS = re.compile(LATIN)
BLANK = re.compile(r"[ \t\n\v\f\r]")


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write the Latin letters beyond ASCII: printable bytes stand for themselves, the
    others follow in order from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    letter = {b: chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(128, 0x180)}


class Known(dict):
    """Ids of words as little-endian bytes. A word not met before is encoded by ``encode`` and remembered."""

    def __init__(self, encode: Callable[[str], bytes]) -> None:
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = ids
        return ids


class Words:
    """Ids of texts as little-endian bytes, word by word: words met before are not encoded again."""

    def __init__(self, vocabulary: str) -> None:
        # Tasks already share the cores.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.model = self.tokenizer.model
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.known = Known(self.word)
        self.letters = byte_letters()
        # Words of Latin letters go straight to the merges if that gives this vocabulary's ids.
        self.straight = all(self.merged(w.lower()) == self.whole(w) for w in ("The", "\u00c9tait", "na\u00efvet\u00e9", "z\u0142oty"))

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def whole(self, text: str) -> bytes:
        """By all steps of the tokenizer."""
        return self.packed(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def merged(self, small: str) -> bytes:
        """A word of small Latin letters, without the steps that would leave it as it is."""
        return self.packed([t.id for t in self.model.tokenize(small if small.isascii() else small.translate(self.letters))])

    def word(self, word: str) -> bytes:
        if not self.straight or not LETTERS.fullmatch(word):
            return self.whole(word)
        small = word.lower()
        return self.merged(small) if small == word else self.known[small]

    def parts(self, text: str) -> Iterator[list[str]]:
        """The words of bounded parts of a text; a part ends behind a word."""
        begin = 0
        while begin < len(text):
            blank = BLANK.search(text, begin + PART)
            end = blank.start() if blank else len(text)
            yield WORDS.findall(text, begin, end)
            begin = end

    def encode(self, text: str) -> bytes:
        return b"".join([b"".join(map(self.known.__getitem__, words)) for words in self.parts(text)])


@cache
def words_by(vocabulary: str) -> Words:
    """One for all tasks of a worker, so that they share the words met."""
    return Words(vocabulary)


def checksum(ids: np.ndarray) -> int:
    """Of the ids as little-endian numbers of four bytes."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def class_of(length: int, room: int, width: int) -> int:
    """The largest length of the class, in units of ``width``; 0 for none."""
    wide = 1 if length <= WIDER[0] * room else 2 if length <= WIDER[1] * room else 4
    return -(-length // (wide * width)) * wide


def _encoded(vocabulary: str, end_id: int, room: int, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: its number, ids, and its tail's class and place among the task's tails of that class."""
    words = words_by(vocabulary)
    part = TaskContext.get().partitionId()
    done, whole = 0, 0
    tails = np.zeros(-(-room // width) + 1, dtype=np.int64)
    for batch in batches:
        numbers, ids, lengths, classes, places, before, crcs, tail_crcs = [], [], [], [], [], [], [], []
        texts = pc.fill_null(batch.column(1), "").to_pylist()
        for text in texts:
            own = np.append(np.frombuffer(words.encode(text), dtype=words.kind), words.kind.type(end_id))
            tail = len(own) % room
            at = class_of(tail, room, width)
            numbers.append((part << 32) + done)
            ids.append(own.tobytes())
            lengths.append(len(own))
            classes.append(at)
            places.append(int(tails[at]))
            before.append(whole)
            crcs.append([checksum(own[b : b + room]) for b in range(0, len(own) - room + 1, room)])
            tail_crcs.append(checksum(own[len(own) - tail :]))
            tails[at] += 1
            whole += len(crcs[-1])
            done += 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(numbers, pa.int64()),
                batch.column(0),
                pa.array([part] * len(numbers), pa.int32()),
                pa.array(ids, pa.binary()),
                pa.array(lengths, pa.int64()),
                pa.array(classes, pa.int32()),
                pa.array(places, pa.int64()),
                pa.array(before, pa.int64()),
                pa.array(crcs, pa.list_(pa.int64())),
                pa.array(tail_crcs, pa.int64()),
            ],
            ["doc", "doc_id", "part", "ids", "doc_tokens", "class", "place", "whole_before", "crcs", "tail_crc"],
        )


def knapsack(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: its value and how many of each size it takes. ``sizes`` rise."""
    best, taken = np.zeros(room + 1), np.full(room + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(room + 1), side="right")
    for r in range(1, room + 1):
        best[r] = best[r - 1]
        if fitting[r]:
            values = best[r - sizes[: fitting[r]]] + prices[: fitting[r]]
            k = int(values.argmax())
            if values[k] > best[r] + 1e-12:
                best[r], taken[r] = values[k], k
    pattern, r = np.zeros(len(sizes)), room
    while r > 0:
        if taken[r] < 0:
            r -= 1
        else:
            pattern[taken[r]] += 1
            r -= int(sizes[taken[r]])
    return float(best[room]), pattern


def column_generation(sizes: np.ndarray, demand: np.ndarray, room: int, gap: float = GAP) -> tuple[list[np.ndarray], np.ndarray, float]:
    """Patterns, how often the linear program takes each, and a lower bound of its value.

    The least number of sequences, fractions allowed, whose patterns take ``demand`` of each of ``sizes``.
    The basis starts with patterns of one size. Each round prices the sizes, lets the knapsack find the pattern
    worth most, and brings it in by the ratio test; with every pattern worth at most v, the present value over v is
    a lower bound (Farley), and so is the room that all of it needs. A surplus comes in where a price would be
    negative. The sums are einsums: their matrices are too small for threads.
    """
    m = len(sizes)
    columns = np.diag((room // sizes).astype(float))
    costs, inverse = np.ones(m), np.diag(1.0 / (room // sizes))
    x, bound = demand / (room // sizes), float(demand @ sizes) / room
    for _ in range(MOST_ROUNDS):
        prices = np.einsum("i,ij->j", costs, inverse)
        if prices.min() < -1e-9:
            entering, cost = np.zeros(m), 0.0
            entering[int(prices.argmin())] = -1.0
        else:
            value, entering = knapsack(np.maximum(prices, 0.0), sizes, room)
            total, cost = float(costs @ x), 1.0
            bound = max(bound, total / max(value, 1.0))
            if value <= 1 + 1e-9 or total - bound <= gap * total:
                break
        step = np.einsum("ij,j->i", inverse, entering)
        ratios = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1.0), np.inf)
        least = ratios.min()
        # Of rows that tie the largest pivot leaves, for the sake of rounding.
        row = int(np.where(ratios <= least + 1e-9, step, -np.inf).argmax())
        pivot = inverse[row] / step[row]
        inverse -= np.outer(step, pivot)
        inverse[row] = pivot
        columns[:, row], costs[row] = entering, cost
        x = np.maximum(np.einsum("ij,j->i", inverse, demand), 0.0)
    used = [k for k in range(m) if costs[k] and x[k] > 1e-9]
    return [columns[:, k] for k in used], x[used], bound


def plan(counts: dict[int, int], room: int, gap: float = GAP) -> tuple[list[tuple[dict[int, int], int]], float]:
    """Patterns {size: tails} with the number of sequences that take each, for so many tails of each size; and
    the lower bound of the number of sequences.

    Shares are rounded down, and what a pattern takes beyond the demand is left empty. The tails that remain,
    less than one sequence for each pattern, are put together by best fit decreasing.
    """
    if not counts:
        return [], 0.0
    sizes = np.array(sorted(counts))
    demand = np.array([counts[int(s)] for s in sizes], dtype=float)
    patterns, shares, bound = column_generation(sizes, demand, room, gap)
    open_ = {int(s): counts[int(s)] for s in sizes}
    planned: list[tuple[dict[int, int], int]] = []
    for pattern, share in sorted(zip(patterns, shares), key=lambda p: -p[1]):
        taken = {int(s): int(n) for s, n in zip(sizes, pattern) if n}
        times = min([int(share + 1e-6), *[open_[s] // n for s, n in taken.items()]])
        if times > 0:
            planned.append((taken, times))
            for s, n in taken.items():
                open_[s] -= n * times
    rest = [s for s, n in open_.items() for _ in range(n)]
    same: dict[tuple, int] = {}
    for row in best_fit(rest, room):
        key = tuple(sorted(rest[p] for p in row))
        same[key] = same.get(key, 0) + 1
    for key, times in same.items():
        planned.append(({s: key.count(s) for s in set(key)}, times))
    return planned, bound


class Places:
    """From the place of a tail among all, ordered by class and rank, to its sequence and its place there."""

    def __init__(self, planned: list[tuple[dict[int, int], int]], classes: int) -> None:
        entries: dict[int, list[tuple[int, int, int, int]]] = {}
        first = 0
        for taken, times in planned:
            before = 0
            for size, n in sorted(taken.items(), reverse=True):
                entries.setdefault(size, []).append((n * times, n, first, before))
                before += n
            first += times
        self.sequences = first
        totals = np.zeros(classes, dtype=np.int64)
        starts, each, firsts, slots = [], [], [], []
        at = 0
        for size in sorted(entries):
            totals[size] = at
            for tails, n, sequence, before in entries[size]:
                starts.append(at)
                each.append(n)
                firsts.append(sequence)
                slots.append(before)
                at += tails
        self.class_start = totals
        self.starts, self.each, self.firsts, self.slots = (np.array(v, dtype=np.int64) for v in (starts, each, firsts, slots))

    def of(self, classes: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.class_start[classes] + ranks
        entry = np.searchsorted(self.starts, at, side="right") - 1
        inside = at - self.starts[entry]
        return self.firsts[entry] + inside // self.each[entry], self.slots[entry] + inside % self.each[entry]


def _placed(places, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sequence, slot = places.value.of(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[2:], pa.array(sequence), pa.array(slot)], [*batch.schema.names[2:], "tail_sequence", "slot"]
        )


def _checked(kind: np.dtype, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The checksum of the ids from start to start + length, in place of the ids."""
    for batch in batches:
        starts, lengths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        crcs = [checksum(np.frombuffer(ids, dtype=kind)[s : s + n]) for ids, s, n in zip(batch.column(0).to_pylist(), starts, lengths)]
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(crcs, pa.int64())], [*batch.schema.names[1:], "ids_crc32"])


def pack_by_patterns(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    end_id: int = END_ID,
    room: int = ROOM,
    width: int = WIDTH,
    gap: float = GAP,
    padding: float = PADDING,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens.

    A document is its ids and ``end_id``; null and empty texts are ``end_id`` alone. Piece i of a document has its
    ids from ``start``; it lies at ``offset`` of its sequence, without gaps. Sequences hold ``room`` tokens, a power of
    two, at most; ``sequence_tokens`` is what they hold, and they are padded to ``room`` unless that is a power of two.
    Documents are cut every ``room`` tokens, and where their tail's sequence would be padded by more than
    ``padding`` of ``room``, at the powers of two that make up that sequence. Repeated rows are packed again; a
    missing id is null. An empty table gives no rows. Strings of special tokens in a text get their ids, as the
    tokenizer has it by default. ``vocabulary`` (default: the public word vocabulary) is read by every task.

    Jobs run when this is called. To the driver come the counts of the at most room / width + 1 classes; the linear
    program is of that size whatever the data. Numbers of sequences are unique, not dense.
    """
    if room < 4 * width or room & (room - 1):
        raise ValueError("room must be a power of two and hold four widths of a class")
    spark = df.sparkSession
    rows = renamed(df, doc_id=id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    shape = (
        f"doc bigint, doc_id {kind}, part int, ids binary, doc_tokens bigint, class int, place bigint, whole_before bigint, "
        "crcs array<bigint>, tail_crc bigint"
    )
    encoded = stage(rows.mapInArrow(lambda batches: _encoded(path, end_id, room, width, batches), shape), "encoded")
    # One row per task and class.
    counts = stage(encoded.groupBy("part", "class").agg(F.count(F.lit(1)).alias("n")), "class-counts")
    totals = {r["class"]: r["n"] for r in counts.where(F.col("class") > 0).groupBy("class").agg(F.sum("n").alias("n")).collect()}
    planned, _ = plan(totals, room // width, gap)
    places = Places(planned, room // width + 1)
    sent = spark.sparkContext.broadcast(places)
    earlier = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("part", "class", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    tails = encoded.where(F.col("class") > 0).join(ahead, ["part", "class"])
    tails = tails.select(
        F.col("class").cast("bigint").alias("class"),
        (F.col("ahead") + F.col("place")).alias("rank"),
        "doc",
        "doc_id",
        (F.col("doc_tokens") - F.col("doc_tokens") % room).alias("start"),
        (F.col("doc_tokens") % room).alias("length"),
        F.col("tail_crc").alias("ids_crc32"),
        "doc_tokens",
    )
    held = f"doc bigint, doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, tail_sequence bigint, slot bigint"
    placed = tails.mapInArrow(lambda batches: _placed(sent, batches), held)
    # A sequence has at most ``room`` pieces.
    inside = Window.partitionBy("tail_sequence")
    laid = placed.select(
        "*",
        (F.sum("length").over(inside.orderBy("slot")) - F.col("length")).alias("offset"),
        F.sum("length").over(inside).alias("sequence_tokens"),
    )
    laid = stage(laid, "laid")
    full = F.col("sequence_tokens") >= room - int(padding * room)
    # Sixteen numbers for each sequence: itself, or its parts by their power of two.
    powers = room.bit_length()
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens"]
    whole_tails = laid.where(full).withColumn("sequence_id", F.col("tail_sequence") * powers).select(*columns)
    cut = laid.where(~full).withColumn("power", F.explode(F.sequence(F.lit(0), F.lit(powers - 2))))
    # The bits of the number of tokens are the parts, the largest first; ``begin`` is what the larger bits add up to.
    one, begin = F.expr("shiftleft(1L, power)"), F.expr("shiftleft(shiftright(sequence_tokens, power + 1), power + 1)")
    cut = cut.where(F.col("sequence_tokens").bitwiseAND(one) > 0).withColumns({"begin": begin, "one": one})
    low, high = F.greatest("offset", "begin"), F.least(F.col("offset") + F.col("length"), F.col("begin") + F.col("one"))
    cut = cut.where(low < high).select(
        "doc",
        (F.col("start") + low - F.col("offset")).alias("start"),
        (high - low).alias("length"),
        "doc_tokens",
        (F.col("tail_sequence") * powers + F.col("power")).alias("sequence_id"),
        (low - F.col("begin")).alias("offset"),
        F.col("one").alias("sequence_tokens"),
    )
    # Written, so that the planner knows how few they are and leaves the ids where they lie.
    cut = stage(cut, "cut")
    words = np.dtype("<u2") if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else np.dtype("<u4")
    with_ids = encoded.select("doc", "doc_id", "ids").join(cut, "doc").select(
        "ids", "start", "length", "doc_id", "doc_tokens", "sequence_id", "offset", "sequence_tokens"
    )
    checked_shape = f"start bigint, length bigint, doc_id {kind}, doc_tokens bigint, sequence_id bigint, offset bigint, sequence_tokens bigint, ids_crc32 bigint"
    checked = with_ids.mapInArrow(lambda batches: _checked(words, batches), checked_shape).select(*columns)
    # Whole pieces are numbered behind the tails' sequences.
    wholes = encoded.groupBy("part").agg(F.sum(F.size("crcs")).alias("n"))
    before = wholes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    long_ones = encoded.where(F.size("crcs") > 0).select("part", "doc_id", "doc_tokens", "whole_before", "crcs").join(before, "part")
    wholly = long_ones.select("doc_id", "doc_tokens", "whole_before", "ahead", F.posexplode("crcs").alias("nth", "ids_crc32")).select(
        "doc_id",
        (F.col("nth") * F.lit(room).cast("bigint")).alias("start"),
        F.lit(room).cast("bigint").alias("length"),
        "ids_crc32",
        "doc_tokens",
        ((F.lit(places.sequences).cast("bigint") + F.col("ahead") + F.col("whole_before") + F.col("nth")) * powers).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
        F.lit(room).cast("bigint").alias("sequence_tokens"),
    )
    return whole_tails.unionByName(checked).unionByName(wholly)
