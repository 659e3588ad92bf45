"""Hard negatives by bounds along spanning trees of anchors.

1. Anchors are dealt to blocks of a bounded number of bytes. In a task of its own each block gets the minimum
   spanning tree of its anchors under Euclidean distance.
2. A few blocks at a time, of a bounded size together, are sent to all tasks, which pass their rows along the
   trees. The score of a row at a parent, plus or minus the edge's length times the row's norm, bounds its score
   at the child; a bound that does not meet what the child still looks for is handed on to its own children,
   and only rows whose bounds meet it are scored again. The first pass looks for the best rows of the anchor's
   label, the second for rows of other labels inside the windows that those scores open.
3. A task returns a few rows per anchor, which a window function merges. Bounds only save work: results are
   those of scoring everything.

The rows of a block are read twice, whatever the number of its anchors, and nothing but the few best is
shuffled. Work is anchors times rows at worst, as the question asks; anchors never meet in one task or on the
driver but in blocks.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourtide.llm.common import renamed, stage

POSITIVES = 5
NEGATIVES = 3
ANCHOR_STEP, RELABEL_STEP, LABELS = 50, 7, 10
#: A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 50, 95
SCALE = 256
#: Bytes of vectors in a block and in a broadcast of blocks.
BLOCK_BYTES = 4 << 20
SENT_BYTES = 16 << 20
MOST_ANCHORS = 1024
#: Rows that go along a tree at once.
ROWS = 1024
LEAST_LONG, MOST_LONG = -(2**63), 2**63 - 1


def quantised(vectors: pa.Array, width: int | None = None) -> np.ndarray:
    """floor(256 x) of each component as doubles, one row per vector; shorter ones are filled up with zeros, and
    longer ones cut, to ``width`` (default: the longest)."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(lengths.max(initial=0)) if width is None else width
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    rows = np.zeros((len(lengths), width))
    starts = np.cumsum(lengths) - lengths
    for row, (start, length) in enumerate(zip(starts.tolist(), np.minimum(lengths, width).tolist())):
        rows[row, :length] = flat[start : start + length]
    return rows


def small_enough(width: int) -> float:
    """Products of ``width`` components up to this size add up to a whole number that a double holds exactly."""
    return float(np.floor(np.sqrt(2.0**53 / max(1, width))))


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge): parents come first in ``order``. The zero vector (-1), at which every row scores 0,
    is the root of the tree and may have several children."""
    n = len(vectors)
    edge, parent, order = np.sqrt((vectors * vectors).sum(axis=1)), np.full(n, -1), []
    open_ = np.ones(n, dtype=bool)
    for _ in range(n):
        at = int(np.argmin(np.where(open_, edge, np.inf)))
        order.append(at)
        open_[at] = False
        away = vectors - vectors[at]
        away = np.sqrt((away * away).sum(axis=1))
        closer = open_ & (away < edge)
        edge[closer], parent[closer] = away[closer], at
    return np.array(order), parent, edge


def _trees(width: int, frame: pd.DataFrame) -> pd.DataFrame:
    """The rows of one block as one row: the numbers, ids, labels and vectors of its anchors, in the tree's order."""
    frame = frame.sort_values("anchor", kind="stable")
    vectors = quantised(pa.array(frame["vector"].to_list(), pa.list_(pa.float64())), width)
    order, parent, edge = spanning_tree(vectors)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    up = np.where(parent[order] < 0, -1, place[parent[order]])
    whole = {
        "block": frame["block"].iloc[0],
        "anchors": frame["anchor"].to_numpy()[order].tolist(),
        "ids": frame["vec_id"].to_numpy()[order].tolist(),
        "labels": frame["label"].to_numpy()[order].tolist(),
        "parents": up.tolist(),
        "edges": edge[order].tolist(),
        "vectors": vectors[order].astype("<f8").tobytes(),
    }
    return pd.DataFrame([whole])


class Best:
    """The first ``most`` (score, id) per slot: higher scores first, then smaller ids, missing ids last."""

    def __init__(self, slots: int, most: int) -> None:
        self.most = most
        self.scores = [np.zeros(0, dtype=np.int64)] * slots
        self.ids = [np.zeros(0, dtype=np.int64)] * slots
        self.missing = [np.zeros(0, dtype=bool)] * slots
        #: What a score must reach to count.
        self.least = np.full(slots, -np.inf)

    def add(self, slot: int, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        scores, ids = np.append(self.scores[slot], scores), np.append(self.ids[slot], ids)
        missing = np.append(self.missing[slot], missing)
        # The complement falls as the score rises, and unlike the negative it always fits.
        first = np.lexsort((ids, missing, ~scores))[: self.most]
        self.scores[slot], self.ids[slot], self.missing[slot] = scores[first], ids[first], missing[first]
        if len(first) == self.most:
            self.least[slot] = float(scores[first[-1]])

    def rows(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        for slot, scores in enumerate(self.scores):
            if len(scores):
                yield slot, scores, self.ids[slot], self.missing[slot]


class Rows:
    """Some rows as the trees need them: ids, labels, vectors and norms."""

    def __init__(self, ids: np.ndarray, missing: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.missing, self.labels, self.vectors = ids, missing, labels, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        largest = np.abs(vectors).max(axis=1, initial=0)
        self.plain = bool((largest <= small_enough(vectors.shape[1])).all())

    def scores(self, at: np.ndarray, anchor: np.ndarray, plain: bool) -> np.ndarray:
        """Exact; where a double might round, Python's whole numbers are added up and cut to what a long holds."""
        if plain:
            part = self.vectors if len(at) == len(self.vectors) else self.vectors[at]
            return (part @ anchor).astype(np.int64)
        whole = [int(x) for x in anchor]
        sums = [sum(int(x) * y for x, y in zip(self.vectors[i], whole)) for i in at.tolist()]
        return np.array([min(MOST_LONG, max(LEAST_LONG, s)) for s in sums], dtype=np.int64)


def parts_of(batch: pa.RecordBatch, width: int) -> Iterator[Rows]:
    for begin in range(0, batch.num_rows, ROWS):
        ids, labels, vectors = (batch.column(c).slice(begin, ROWS) for c in range(3))
        missing = ids.is_null().to_numpy(zero_copy_only=False)
        yield Rows(pc.fill_null(ids, 0).to_numpy(), missing, labels.to_numpy(zero_copy_only=False), quantised(vectors, width))


class Tree:
    def __init__(self, row: dict, width: int) -> None:
        self.anchors, self.ids, self.labels, self.parents = row["anchors"], row["ids"], row["labels"], row["parents"]
        self.vectors = np.frombuffer(row["vectors"], dtype="<f8").reshape(len(self.anchors), width)
        norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        # Rounding may not carry a score out of its bounds.
        self.edges = (np.array(row["edges"]) + 1e-9 * norms).tolist()
        self.plain = (np.abs(self.vectors).max(axis=1, initial=0) <= small_enough(width)).tolist()

    def walk(self, rows: Rows, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor's place, places of rows, their scores) for the rows whose bounds meet what is wanted:
        ``wanted(place, low, high)`` is a mask."""
        n = len(rows.ids)
        low, high = np.empty((len(self.anchors), n)), np.empty((len(self.anchors), n))
        for at, (parent, edge) in enumerate(zip(self.parents, self.edges)):
            reach = rows.norms * edge + 1
            low[at] = (low[parent] if parent >= 0 else 0.0) - reach
            high[at] = (high[parent] if parent >= 0 else 0.0) + reach
            hits = np.flatnonzero(wanted(at, low[at], high[at]))
            if len(hits):
                plain = rows.plain and self.plain[at]
                scores = rows.scores(hits, self.vectors[at], plain)
                if plain:
                    low[at, hits] = high[at, hits] = scores
                yield at, hits, scores


def _best_of_label(trees: list[Tree], most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, score, id) of a task's best rows of each anchor's own label."""
    found = [Best(len(t.anchors), most) for t in trees]
    for batch in batches:
        for rows in parts_of(batch, trees[0].vectors.shape[1]):
            for tree, best in zip(trees, found):

                def wanted(at, low, high):
                    return (rows.labels == tree.labels[at]) & (high >= best.least[at])

                for at, hits, scores in tree.walk(rows, wanted):
                    best.add(at, scores, rows.ids[hits], rows.missing[hits])
    for tree, best in zip(trees, found):
        yield _rows_of([((tree.anchors[at],), *row) for at, *row in best.rows()], ["anchor"])


def _rows_of(found: list[tuple], names: list[str]) -> pa.RecordBatch:
    """One batch of (what ``names`` says, score, id) from (those values, scores, ids, missing)."""
    sizes = [len(scores) for _, scores, _, _ in found]
    joined = [np.concatenate([np.zeros(0, dtype=kind), *[f[k] for f in found]]) for k, kind in ((1, np.int64), (2, np.int64), (3, bool))]
    same = [pa.array(np.repeat(np.array([f[0][k] for f in found], dtype=np.int64), sizes)) for k in range(len(names))]
    return pa.RecordBatch.from_arrays([*same, pa.array(joined[0]), pa.array(joined[1], mask=joined[2])], [*names, "score", "id"])


def window(positive_score: int, low: int, high: int) -> tuple[int, int]:
    """The least and largest whole score between ``low`` and ``high`` hundredths of a positive's."""
    return -((-low * positive_score) // 100), (high * positive_score) // 100


def _best_in_windows(
    trees: list[Tree], windows: dict[int, list[tuple[int, int, int]]], most: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """(anchor, place, score, id) of a task's best rows of other labels in each (place, least, largest) of
    ``windows``."""
    slots = [[[w for w in windows.get(a, []) if w[1] <= w[2]] for a in t.anchors] for t in trees]
    found = [[Best(len(of), most) for of in s] for s in slots]
    for batch in batches:
        for rows in parts_of(batch, trees[0].vectors.shape[1]):
            for tree, opened, best in zip(trees, slots, found):

                def wanted(at, low, high):
                    if not opened[at]:
                        return np.zeros(len(low), dtype=bool)
                    least = min(max(w[1], best[at].least[k]) for k, w in enumerate(opened[at]))
                    return (high >= least) & (low <= max(w[2] for w in opened[at])) & (rows.labels != tree.labels[at])

                for at, hits, scores in tree.walk(rows, wanted):
                    for slot, (_, least, largest) in enumerate(opened[at]):
                        inside = (scores >= max(least, best[at].least[slot])) & (scores <= largest)
                        if inside.any():
                            best[at].add(slot, scores[inside], rows.ids[hits][inside], rows.missing[hits][inside])
    for tree, opened, best in zip(trees, slots, found):
        each = [((anchor, opened[at][slot][0]), *row) for at, anchor in enumerate(tree.anchors) for slot, *row in best[at].rows()]
        yield _rows_of(each, ["anchor", "place"])


def usable(df: DataFrame, id: str, vector: str, label: str) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part: nothing null or without bound but the id."""
    rows = renamed(df, vec_id=id, label=label, vector=vector)
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)


def relabelled(vec_id: Column, label: Column) -> Column:
    moved = ((label.cast("bigint") + 1) % LABELS).cast("bigint")
    return F.when(vec_id % RELABEL_STEP == 0, moved).otherwise(label.cast("bigint"))


def hard_negatives(
    df: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block_bytes: int = BLOCK_BYTES,
    sent_bytes: int = SENT_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and positive the
    first ``negatives`` rows of other labels that score between ``low`` and ``high`` hundredths of the positive.

    Rows with a null label or vector, or with a null or non-finite component, take no part; a missing id does
    and comes last among ties, but is no anchor. Labels of ids divisible by 7 are moved on by one first. Vectors of
    unequal length count as filled up with zeros. Scores beyond a long are cut to its limits. A repeated row is a row: an anchor's copy
    is one of its positives, and a repeated anchor has its rows again. Ids that tie come out as often as they
    occur. A positive that scores 0 or less opens no window but that of equal scores at 0. An empty table, one label, or one row
    gives no rows. Jobs run when this is called: per ``sent_bytes`` of anchors two passes over the rows.
    """
    spark = df.sparkSession
    rows = usable(df, id, vector, label)
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), relabelled(F.col("vec_id"), F.col("label")).alias("label"), F.col("vector").cast("array<double>").alias("vector"))
    chosen = stage(rows.where(F.col("vec_id") % ANCHOR_STEP == 0).withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    n, width = chosen.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    empty = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not n:
        return spark.createDataFrame([], empty)
    per_block = max(1, min(MOST_ANCHORS, block_bytes // (8 * max(1, width))))
    n_blocks = -(-n // per_block)
    dealt = chosen.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(n_blocks)).cast("int"))
    shape = "block int, anchors array<bigint>, ids array<bigint>, labels array<bigint>, parents array<int>, edges array<double>, vectors binary"
    trees = stage(dealt.groupBy("block").applyInPandas(lambda frame: _trees(width, frame), shape), "anchor-trees")
    at_once = max(1, sent_bytes // (8 * max(1, width) * per_block))
    results = []
    for begin in range(0, n_blocks, at_once):
        some = [r.asDict() for r in trees.where(F.col("block").between(begin, begin + at_once - 1)).collect()]
        if some:
            results.append(_of_blocks(rows, some, width, positives, negatives, low, high))
    return functools.reduce(DataFrame.unionAll, results)


def _of_blocks(rows: DataFrame, blocks: list[dict], width: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """The result for the anchors of some blocks, written."""
    context = rows.sparkSession.sparkContext
    sent = context.broadcast(blocks)
    best_first = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    # One more than is wanted, as an anchor meets itself.
    near = rows.mapInArrow(
        lambda batches: _best_of_label([Tree(b, width) for b in sent.value], positives + 1, batches), "anchor bigint, score bigint, id bigint"
    )
    first = near.withColumn("n", F.row_number().over(Window.partitionBy("anchor").orderBy(*best_first))).where(F.col("n") <= positives + 1)
    selves = rows.sparkSession.createDataFrame(_self_scores(blocks, width), "anchor bigint, anchor_id bigint, own bigint")
    known = first.join(F.broadcast(selves), "anchor")
    # Rows with the anchor's id and its score with itself answer alike: any one of them is the anchor.
    itself = F.coalesce((F.col("id") == F.col("anchor_id")) & (F.col("score") == F.col("own")), F.lit(False))
    which = F.row_number().over(Window.partitionBy("anchor", "itself").orderBy("n"))
    others = known.withColumn("itself", itself).withColumn("which", which).where(~F.col("itself") | (F.col("which") > 1))
    place = F.row_number().over(Window.partitionBy("anchor").orderBy("n"))
    mates = others.withColumn("place", place).where(F.col("place") <= positives)
    mates = stage(mates.select("anchor", "anchor_id", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # At most ``positives`` rows of three numbers for each anchor of the blocks.
    windows: dict[int, list[tuple[int, int, int]]] = {}
    for r in mates.select("anchor", "place", "positive_score").collect():
        windows.setdefault(r["anchor"], []).append((r["place"], *window(r["positive_score"], low, high)))
    opened = context.broadcast(windows)
    hard = rows.mapInArrow(
        lambda batches: _best_in_windows([Tree(b, width) for b in sent.value], opened.value, negatives, batches),
        "anchor bigint, place bigint, score bigint, id bigint",
    )
    rank = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(*best_first))
    ranked = hard.withColumn("rank", rank).where(F.col("rank") <= negatives)
    found = ranked.join(mates, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
    return stage(found, "hard-negatives")


def _self_scores(blocks: list[dict], width: int) -> list[tuple[int, int, int]]:
    """(number, id, score with itself) of the anchors."""
    scores = []
    for tree in (Tree(b, width) for b in blocks):
        for anchor, name, vector in zip(tree.anchors, tree.ids, tree.vectors):
            scores.append((anchor, name, min(MOST_LONG, sum(int(x) * int(x) for x in vector))))
    return scores


SQL = f"""
with vectors as (
  select vec_id, case when vec_id % {RELABEL_STEP} = 0 then (label + 1) % {LABELS} else label end as label,
    list_transform(embedding, lambda x: floor({SCALE} * cast(x as double))) as vector
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, r.vec_id as id, a.label = r.label as alike, cast(list_dot_product(a.vector, r.vector) as bigint) as score
  from vectors a join vectors r on a.vec_id <> r.vec_id where a.vec_id % {ANCHOR_STEP} = 0
), positives as (
  select anchor_id, id as positive_id, score as positive_score from scored where alike
  qualify row_number() over (partition by anchor_id order by score desc, id) <= {POSITIVES}
), ranked as (
  select p.anchor_id, positive_id, positive_score, s.id as negative_id, s.score as negative_score,
    row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.id) as rank
  from positives p join scored s on p.anchor_id = s.anchor_id and not alike
    and {LOW} * positive_score <= 100 * s.score and 100 * s.score <= {HIGH} * positive_score
)
select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score from ranked where rank <= {NEGATIVES}
"""
