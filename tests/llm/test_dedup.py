import hashlib
import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from hourtide.llm import components, grace_dedup, simhash
from tests_llm_plain import plain_components, plain_fingerprint


def normalised(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def test_exact_groups_equal_brute_force(spark, documents):
    """With tables of a few kilobytes, so that tables are closed and buckets partitioned again."""
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    groups = defaultdict(list)
    for i, text in texts.items():
        groups[normalised(text)].append(i)
    found = {r["doc_id"]: r for r in grace_dedup.exact_dedup(documents.repartition(3), table_bytes=4000).collect()}
    assert set(found) == set(texts)
    for content, members in groups.items():
        keep = min(members, key=lambda i: (-len(texts[i] or ""), i))
        sha = hashlib.sha256(content.encode()).hexdigest()
        for i in members:
            assert (found[i]["keep_id"], found[i]["group_size"], found[i]["text_sha256"]) == (keep, len(members), sha)
            assert found[i]["kept"] == (i == keep)


def test_copies_of_a_third_of_all_rows_leave_a_task_once(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    found = grace_dedup.exact_dedup(df.repartition(4), table_bytes=1000)
    assert found.where("group_size = 1000").count() == 1000 and found.where("kept").count() == 2001


def test_equal_hashes_of_different_contents_stay_apart():
    table = grace_dedup.ContentTable()
    assert table.place(7, b"a") == (0, True) and table.place(7, b"b") == (1, True) and table.place(7, b"a") == (0, False)
    for i in range(1000):
        table.place(i % 10, str(i).encode())
    assert all(table.place(i % 10, str(i).encode())[1] is False for i in range(1000))


def test_near_groups_equal_brute_force(spark, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    marks = {i: plain_fingerprint(t) for i, t in texts.items()}
    roots = plain_components(sorted(set(marks.values())))
    smallest = {}
    for i, m in marks.items():
        smallest[roots[m]] = min(i, smallest.get(roots[m], i))
    found = {r["doc_id"]: r for r in simhash.near_groups(documents).collect()}
    assert {i: r["fingerprint"] for i, r in found.items()} == {i: f"{m:016x}" for i, m in marks.items()}
    assert {i: r["component_id"] for i, r in found.items()} == {i: smallest[roots[m]] for i, m in marks.items()}
    kept = sorted(r["doc_id"] for r in simhash.near_dedup(documents).select("doc_id").collect())
    assert kept == sorted(set(smallest.values()))


def test_crowded_cells_and_planted_distances(spark):
    """Clusters around a few centres and chains of 3-bit steps, with cells cut into chunks of 8."""
    rng = random.Random(3)
    marks = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        marks |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(60)}
    link = rng.getrandbits(64)
    for _ in range(30):
        link ^= sum(1 << b for b in rng.sample(range(64), 3))
        marks.add(link)
    marks |= {rng.getrandbits(64) for _ in range(200)}
    marks |= {0, 1, 3, 7, 15, (1 << 64) - 1}
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    nodes = spark.createDataFrame([(signed(m),) for m in marks], "fp bigint")
    expected = plain_components(sorted(marks))
    for chunk in (8, 4096):
        roots = {r["node"]: r["root"] for r in components.components(simhash.close_links(nodes, chunk=chunk)).collect()}
        classes = defaultdict(set)
        for m in marks:
            classes[roots.get(signed(m), signed(m))].add(m)
        plain = defaultdict(set)
        for m, r in expected.items():
            plain[r].add(m)
        assert sorted(map(sorted, classes.values())) == sorted(map(sorted, plain.values()))


def test_long_chains_are_contracted(spark):
    order = list(range(200))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:])), "a bigint, b bigint")
    assert {r["root"] for r in components.components(links).collect()} == {0}
    assert components.components(links.where("false")).count() == 0


def test_fingerprint_counts_long_texts_in_parts(monkeypatch):
    text = " ".join(f"w{i % 300}" for i in range(5000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "COUNTED", 100)
    assert simhash.fingerprint(text.encode()) == whole == plain_fingerprint(text)
    assert np.uint64(whole) == whole


def test_one_row_of_each_component(spark):
    """Copies without ids, and two texts of different components under one id."""
    far = ["the quick brown fox jumps over a lazy dog " * 3, "completely other words stand in this text here " * 3, "third kind of sentence with no shared shingle " * 3]
    rows = [(None, far[0], "x"), (None, far[0], "y"), (None, far[0], "x"), (7, far[1], "a"), (7, far[2], "b"), (7, far[2], "b"), (8, far[1], "c")]
    kept = simhash.near_dedup(spark.createDataFrame(rows, "doc_id bigint, text string, mark string").repartition(3)).collect()
    assert sorted(str((r["doc_id"], r["text"])) for r in kept) == sorted(str(x) for x in [(None, far[0]), (7, far[1]), (7, far[2])])
