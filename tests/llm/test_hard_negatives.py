"""Hard negatives against scoring everything."""

import math
import random

import numpy as np
import pytest

from hourtide.llm import hard_negatives as hard

SHAPE = "vec_id bigint, embedding array<float>, label int, score bigint, anchor bigint, block int, n string"


def plain(rows, positives=5, negatives=3):
    used = []
    for vec_id, vector, label, *_ in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        used.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    found = []
    for a, (anchor, label, vector) in enumerate(used):
        if anchor is None or anchor % 50:
            continue
        scored = []
        for r, (other, theirs, v) in enumerate(used):
            score = max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(vector, v))))
            scored.append((-score, other is None, other or 0, r, theirs, other))
        scored.sort()
        near = [(-s[0], s[5]) for s in scored if s[4] == label and s[3] != a][:positives]
        for top, mate in near:
            inside = [s for s in scored if s[4] != label and 50 * top <= -100 * s[0] <= 95 * top][:negatives]
            found += [(anchor, mate, k + 1, s[5], top, -s[0]) for k, s in enumerate(inside)]
    return sorted(found, key=str)


def made(rng, n, dim, spread):
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        rows.append((i, [float(np.float32(x + rng.gauss(0, spread))) for x in c], rng.randrange(10)) + (None,) * 4)
    return rows


def awkward_rows():
    rng = random.Random(3)
    rows = made(rng, 160, 6, 0.3)
    # Repeated rows, anchors and ids among them; ties; nulls; what is not finite; other lengths.
    rows += [rows[0], rows[0], rows[50], rows[7], (50, rows[3][1], rows[50][2], 1, 2, 3, "x")]
    rows += [(None, rows[0][1], rows[0][2], 9, 9, 9, "y"), (None, None, None, None, None, None, None)]
    rows += [(200, [1.0, None, 0.5, 0.0, 0.0, 0.0], 1, 0, 0, 0, ""), (250, [float("nan")] * 6, 1, 0, 0, 0, "")]
    rows += [(300, [float("inf")] * 6, 1, 0, 0, 0, ""), (350, None, 1, 0, 0, 0, ""), (400, [1.0] * 6, None, 0, 0, 0, "")]
    rows += [(450, [], 3, 0, 0, 0, ""), (451, [1.0], 3, 0, 0, 0, ""), (500, [0.5] * 9, -1, 0, 0, 0, ""), (550, [0.0] * 6, 2, 0, 0, 0, "")]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 300, "sent_bytes": 600}])
def test_awkward_rows_as_by_scoring_all(spark, sizes):
    rows = awkward_rows()
    found = hard.hard_negatives(spark.createDataFrame(rows, SHAPE).repartition(3), **sizes).collect()
    ours = sorted([(r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in found], key=str)
    assert ours and ours == plain(rows)


def test_sums_beyond_doubles_and_longs(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([1e6, 3e7, -2e6, 1e15]) * (1 + rng.randrange(5)) for _ in range(3)], i % 2) + (None,) * 4 for i in range(0, 400, 5)]
    rows += [(1001, [3e38, 3e38, -1.0], 0) + (None,) * 4]
    found = hard.hard_negatives(spark.createDataFrame(rows, SHAPE)).collect()
    ours = sorted([(r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in found], key=str)
    assert ours == plain(rows)


def test_nothing_to_return(spark):
    none = spark.createDataFrame([], SHAPE)
    assert hard.hard_negatives(none).count() == 0
    one = spark.createDataFrame([(50, [1.0, 2.0], 1) + (None,) * 4], SHAPE)
    assert hard.hard_negatives(one).count() == 0


def test_bounds_leave_out_rows_and_lose_none():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 300, (5, 16))
    anchors = np.floor(centres[rng.integers(0, 5, 60)] + rng.normal(0, 4, (60, 16)))
    vectors = np.floor(centres[rng.integers(0, 5, 300)] + rng.normal(0, 4, (300, 16)))
    order, parent, edge = hard.spanning_tree(anchors)
    place = np.argsort(order)
    up = np.where(parent[order] < 0, -1, place[parent[order]])
    row = {"anchors": list(range(60)), "ids": order.tolist(), "labels": [0] * 60, "parents": up.tolist(), "edges": edge[order].tolist(), "vectors": anchors[order].astype("<f8").tobytes()}
    rows = hard.Rows(np.arange(300), np.zeros(300, bool), np.zeros(300, int), vectors)
    least = np.sort(vectors @ anchors[order].T, axis=0)[-5]
    scored, hits = 0, 0
    for at, which, scores in hard.Tree(row, 16).walk(rows, lambda at, low, high: high >= least[at]):
        exact = vectors @ anchors[order[at]]
        assert (scores == exact[which]).all() and (exact >= least[at]).sum() == (scores >= least[at]).sum()
        scored, hits = scored + len(which), hits + (scores >= least[at]).sum()
    assert hits >= 300 and scored < 0.5 * 60 * 300


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) + (None,) * 4 for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    from hourtide.llm.queries import QUERIES

    found = QUERIES["op12_hard_negatives"](spark, sf_dir).collect()
    ours = sorted([(r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in found], key=str)
    assert ours == plain(rows)
