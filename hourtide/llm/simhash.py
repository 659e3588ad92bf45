"""Near-duplicates by SimHash, found in a grid over segment popcounts.

A fingerprint's 64 bits are cut into 32 segments of two bits; the numbers of set bits per segment are its
point in a 32-dimensional grid. The Manhattan distance of two points never exceeds the Hamming distance
of the fingerprints, so fingerprints that differ in at most 3 bits have points at most 3 apart, and at
most 1 apart in one half of the dimensions. Each fingerprint therefore enters the cell of either half of
its point and, as a visitor, the cells one step below along each axis: two halves at distance 1 or 0 meet
in a cell where one of them is at home. Whoever meets there is compared bit by bit.

Copies of a fingerprint enter once. A cell hands on the links of a spanning forest of its close pairs, so
what it emits is linear in its members; crowded cells are dealt to tasks as pairs of chunks. Components
come from contraction of the links in written tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourtide.llm.common import LOWER_BYTES, free_name, renamed, stage
from hourtide.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
#: Most differing bits of a link; the two halves of the grid are made for 3 or fewer.
MOST_BITS = 3
#: Members of a cell that one task compares with each other.
CHUNK = 4096
#: Shingles whose bits are counted at once.
COUNTED = 1 << 18
AXES = 16
ODD_BITS = 0x55555555


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Bit i is set if it is set in over half the XXH64 hashes of the shingles; 0 without words."""
    words = text.translate(LOWER_BYTES).split()
    if not words:
        return 0
    last = max(1, len(words) - shingle_words + 1)
    counts = np.zeros(64, dtype=np.int64)
    for begin in range(0, last, COUNTED):
        end = min(begin + COUNTED, last)
        starts = [words[begin + k : end + k] for k in range(shingle_words)] if len(words) >= shingle_words else None
        shingles = map(b" ".join, zip(*starts)) if starts else [b" ".join(words)]
        hashes = np.array(list(map(xxhash.xxh64_intdigest, shingles, repeat(SEED))), dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > last, bitorder="little").view("<u8")[0])


def _fingerprints(shingle_words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.fill_null(batch.column(2), "").cast(pa.binary())
        found = np.array([fingerprint(t.as_py(), shingle_words) for t in texts], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found.view(np.int64))], ["doc_id", "mark", "fp"])


def grid_cells(fp: Column) -> Column:
    """The cells a fingerprint enters: an array of (cell, home). Subtracting the upper bit of each segment
    from the segment leaves its popcount, 0 to 2, in place."""
    halves = [fp.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(fp, 32)]
    cells = []
    for side, bits in enumerate(halves):
        half = bits - F.shiftrightunsigned(bits, 1).bitwiseAND(F.lit(ODD_BITS))
        own = half + F.lit(side << 33)
        cells.append(F.struct(own.alias("cell"), F.lit(True).alias("home")))
        for axis in range(AXES):
            step = 1 << (2 * axis)
            below = F.struct((own - F.lit(step)).alias("cell"), F.lit(False).alias("home"))
            cells.append(F.when(half.bitwiseAND(F.lit(3 * step)) != 0, below))
    return F.array_compact(F.array(*cells))


def forest(members: np.ndarray, home: np.ndarray, most_bits: int) -> list[tuple[int, int]]:
    """Links that connect whatever the close pairs with at least one member at home connect."""
    label = np.arange(len(members))
    links = []
    for i in np.flatnonzero(home):
        close = np.flatnonzero(np.bitwise_count(members ^ members[i]) <= most_bits)
        if len(close) < 2:
            continue
        groups, first = np.unique(label[close], return_index=True)
        if len(groups) > 1:
            links += [(int(members[i]), int(members[close[k]])) for k, g in zip(first, groups) if g != label[i]]
            label[np.isin(label, groups)] = groups[0]
    return links


def _links(most_bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (cell, pair, fp, home), sorted by cell and pair; a group may go on in the next batch."""
    rest: list[np.ndarray] = []

    def groups(columns: list[np.ndarray], bounds: np.ndarray) -> pa.RecordBatch:
        members, home = columns[2].view(np.uint64), columns[3]
        sizes = np.diff(bounds)
        with_home = np.add.reduceat(home.astype(np.int64), bounds[:-1]) > 0
        links = []
        for g in np.flatnonzero((sizes > 1) & with_home):
            part = slice(bounds[g], bounds[g + 1])
            links += forest(members[part], home[part], most_bits)
        pairs = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        if rest:
            columns = [np.concatenate(pair) for pair in zip(rest, columns)]
        new = np.flatnonzero((np.diff(columns[0]) != 0) | (np.diff(columns[1]) != 0)) + 1
        if len(new):
            yield groups([c[: new[-1]] for c in columns], np.concatenate([[0], new]))
            columns = [c[new[-1] :] for c in columns]
        rest = columns
    if rest:
        yield groups(rest, np.array([0, len(rest[0])]))


def close_links(nodes: DataFrame, most_bits: int = MOST_BITS, chunk: int = CHUNK) -> DataFrame:
    """(a, b): links among the distinct fingerprints of ``nodes`` (fp) that connect all that differ in at
    most ``most_bits`` bits."""
    if most_bits > 3:
        raise ValueError("the grid's halves find at most 3 differing bits")
    each = nodes.select("fp", F.explode(grid_cells(F.col("fp"))).alias("at")).select("at.cell", "fp", "at.home")
    sizes = each.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    crowded = stage(sizes.where(F.col("n") > chunk).select("cell", F.ceil(F.col("n") / chunk).cast("int").alias("chunks")), "crowded")
    each = each.withColumn("pair", F.lit(0).cast("bigint"))
    if not crowded.isEmpty():
        joined = each.join(crowded, "cell", "left")
        own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("bigint")
        # Chunk c takes part in the pairs (c, d) with every chunk d of its cell.
        pairs = F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.col("chunks").cast("bigint") - 1),
            lambda d: F.least(own, d) * F.col("chunks") + F.greatest(own, d),
        )
        pair = F.explode(F.coalesce(F.when(F.col("chunks").isNotNull(), pairs), F.array(F.lit(0).cast("bigint"))))
        each = joined.select("cell", "fp", "home", pair.alias("pair"))
    dealt = each.select("cell", "pair", "fp", "home").repartition("cell", "pair").sortWithinPartitions("cell", "pair")
    return dealt.mapInArrow(lambda batches: _links(most_bits, batches), "a bigint, b bigint")


def rooted_fingerprints(df: DataFrame, id: str, text: str, shingle_words: int, most_bits: int, chunk: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, mark, fp) of all rows, and (fp, doc_id, first, root) of the distinct fingerprints: the smallest id, the
    first (missing, id, mark) and the component."""
    rows = renamed(df, doc_id=id, text=text).select("doc_id", F.xxhash64("text").alias("mark"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, mark bigint, fp bigint"
    marked = stage(rows.mapInArrow(lambda batches: _fingerprints(shingle_words, batches), shape), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "mark"))
    nodes = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), first.alias("first")), "nodes")
    roots = components(close_links(nodes.select("fp"), most_bits, chunk))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "doc_id", "first", F.coalesce("root", "fp").alias("root"))
    return marked, stage(rooted, "rooted")


def near_groups(
    df: DataFrame, id: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS, chunk: int = CHUNK
) -> DataFrame:
    """One row per row of ``df``: doc_id, fingerprint (16 hex digits), component_id (smallest id reachable
    over links of at most ``most_bits`` differing bits, the own one included).

    A null text is an empty one: fingerprint zero, linked like any other. Texts with fewer words than a
    shingle are one shingle. A row without an id takes the smallest id of its component, null if there is
    none. Repeated rows are repeated in the result. An empty table gives no rows. Jobs run when this is
    called: fingerprints, links and rounds of contraction are written.
    """
    marked, rooted = rooted_fingerprints(df, id, text, shingle_words, most_bits, chunk)
    smallest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def near_dedup(
    df: DataFrame, id: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS, chunk: int = CHUNK
) -> DataFrame:
    """One row of ``df`` for each component, all columns kept: that with the smallest id, of several texts under it the
    first by xxhash64, and where no row has an id the first by that alone. Of rows alike in id and text any one
    stays. So copies without ids go, and a text of another component stays though its id is another's too. An empty
    table gives no rows."""
    _, rooted = rooted_fingerprints(df, id, text, shingle_words, most_bits, chunk)
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("kept_id"), F.col("first.mark").alias("kept_mark"))
    mark = free_name(df.columns, "mark")
    marked = df.withColumn(mark, F.xxhash64(df[f"`{text}`"]))
    same = marked[f"`{id}`"].eqNullSafe(kept["kept_id"]) & (marked[mark] == kept["kept_mark"])
    return marked.join(kept, same, "left_semi").dropDuplicates([id, mark]).drop(mark)
