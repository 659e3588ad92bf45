"""The prefix trie against a plain one."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from hourtide.llm import prefix_trie

SHAPE = "conv_id bigint, turn bigint, role string, text string, id binary, depth int, component string, words int"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append((turn is not None, turn or 0, role, hashlib.sha256(text.encode()).hexdigest(), text))
    said = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in turns.items()}
    members = defaultdict(list)
    built = {}
    for c, own in said.items():
        lent = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = said.get(base, [])[:lent] + own[lent:]
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    below = defaultdict(lambda: [0, 0])
    children = Counter(path[:-1] for path in members if path)
    for path, convs in members.items():
        saved = (len(convs) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            below[path[:d]][0] += saved
            below[path[:d]][1] += not children[path]
    found = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(built[c]) == len(path)))
        parent = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        found.append((min(convs), len(path), parent, len(convs), children[path], below[path][1], below[path][0], digest))
    return sorted(found, key=str)


def ours(frame):
    return sorted([tuple(r[c] for c in COLUMNS) for r in frame.collect()], key=str)


def awkward_rows():
    rng = random.Random(4)
    rows = []
    for conv in [*range(-45, 130), 1000, 1001, 2000]:
        if rng.random() < 0.1:
            continue
        shared = rng.random() < 0.5
        for turn in range(rng.randrange(1, 7)):
            text = f"hot turn {turn}" if shared and turn < 3 else rng.choice(["one two", "", None, "three four x", "a  b\tc"])
            rows.append((conv, rng.choice([turn, turn, None, 2]), rng.choice(["user", "user", None, ""]), text) + (None, 1, "c", None))
    rows += [rows[0], rows[0], rows[5], (None, 1, "user", "lost", None, None, None, None), (200, None, None, None, None, None, None, None)]
    # One long conversation and its copies.
    for conv in (300, 301, 302, 340):
        rows += [(conv, t, "user", f"step {t}", None, t, "", 0) for t in range(40)]
    rows += [(320, 1, "user", "word " * 100_000, None, 0, "", 0)]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"component_turns": 5, "run_levels": 3, "held": 2}, {"component_turns": 60, "run_levels": 1000}])
def test_awkward_rows_as_in_a_plain_trie(spark, sizes):
    rows = awkward_rows()
    assert ours(prefix_trie.trie(spark.createDataFrame(rows, SHAPE).repartition(3), **sizes)) == plain(rows)


def test_empty_and_turnless(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SHAPE)).count() == 0
    # Conversations whose turns all lie before those that count, and whose base is absent.
    lone = [c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4]
    rows = [(c, 0, "user", "x") + (None,) * 4 for c in lone]
    assert ours(prefix_trie.trie(spark.createDataFrame(rows, SHAPE))) == plain(rows)


def test_whole_table(spark, sf_dir):
    from hourtide.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert ours(QUERIES["op13_prefix_trie"](spark, sf_dir)) == plain(rows)


def test_queue_spills_and_keeps_order():
    rng = random.Random(6)
    entries = [(-rng.randrange(9), bytes([rng.randrange(5)] * 16), rng.randrange(100), 1) for _ in range(500)]
    queue = prefix_trie.SpillingQueue(held=20)
    for entry in entries:
        queue.push(entry)
    assert queue.runs and len(queue) > 0
    for level, node in sorted({e[:2] for e in entries}):
        wanted = [e for e in entries if e[:2] == (level, node)]
        assert queue.take(level, node) == (sum(e[2] for e in wanted), len(wanted))
    assert not queue.runs and len(queue) == 0
