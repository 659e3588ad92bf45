"""Sequences by patterns: an exact round trip, little padding, and the linear program against full enumeration."""

import itertools
import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hourtide.llm import cutting_stock

SHAPE = "doc_id bigint, text string, doc bigint, part int, length bigint, ids string, slot int"


def checked(pieces, texts, room):
    """All pieces of a table: each id once, checksums, gapless offsets, room and padding."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = defaultdict(list)
    for doc_id, text in texts:
        ids[doc_id].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [2])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"], p["doc_tokens"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    wanted = defaultdict(list)
    for doc_id, rows in ids.items():
        for row in rows:
            wanted[doc_id, len(row)].append(row)
    assert by_doc.keys() == wanted.keys()
    for key, rows in wanted.items():
        # Copies cannot be told apart: their pieces cover every id as often as there are copies.
        times = [0] * key[1]
        allowed = {}
        for p in by_doc[key]:
            assert 0 < p["length"] and p["start"] + p["length"] <= key[1]
            crcs = {zlib.crc32(struct.pack(f"<{p['length']}I", *row[p["start"] : p["start"] + p["length"]])) for row in rows}
            assert p["ids_crc32"] in crcs
            allowed[p["start"]] = p
            for i in range(p["start"], p["start"] + p["length"]):
                times[i] += 1
        assert times == [len(rows)] * key[1]
    padded = total = 0
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= room and {p["sequence_tokens"] for p in parts} == {at}
        total += at
        padded += 0 if at & (at - 1) == 0 else room - at
    return padded / total if total else 0.0


def awkward_texts():
    rng = random.Random(8)
    words = ["it,was.\"so\"", "AİB,İ.", "e\u0301.,x", "a<\u0338b!", "<|startoftext|>x", "alpha", "beta's", "İstanbul", "x1y22", " ", "naïve!", "<|endoftext|>", "ΣΑΣ", "\x1c", "é"]
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for i in range(120)]
    texts += [(500, None), (501, ""), (502, " \t\n"), (None, "alpha beta"), (None, None), (503, "long words " * 30_000)]
    texts += [texts[3], texts[3], (3, "another text"), (504, "y" * 30_000), (505, " " * 5_000), (506, "\n" * 1_500_000 + "end")]
    return texts


@pytest.mark.parametrize("how", [{}, {"room": 64, "width": 8}, {"room": 64, "width": 1, "padding": 0.0}])
def test_awkward_rows_round_trip(spark, how):
    texts = awkward_texts()
    rows = [t + ((1, 2, 3, "i", 4) if i % 2 else (None,) * 5) for i, t in enumerate(texts)]
    pieces = cutting_stock.pack_by_patterns(spark.createDataFrame(rows, SHAPE).repartition(3), **how).collect()
    room = how.get("room", 4096)
    assert checked(pieces, texts, room) <= (0.0 if how.get("padding") == 0.0 else 1 / 32)


def test_empty_table(spark):
    assert cutting_stock.pack_by_patterns(spark.createDataFrame([], SHAPE)).count() == 0


def test_whole_table(spark, sf_dir):
    from hourtide.llm.queries import QUERIES

    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    pieces = QUERIES["op11_cutting_stock"](spark, sf_dir).collect()
    assert checked(pieces, texts, 4096) < 0.02


def test_words_are_encoded_as_in_whole_texts(monkeypatch):
    monkeypatch.setattr(cutting_stock, "PART", 7)
    monkeypatch.setattr(cutting_stock, "REMEMBERED", 5)
    path = public_tokenizers.path("word_bpe_49k.json")
    words, tokenizer = cutting_stock.Words(path), Tokenizer.from_file(path)
    for _, text in awkward_texts():
        if text and len(text) < 100_000:
            assert np.frombuffer(words.encode(text), words.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_words_of_all_latin_letters():
    path = public_tokenizers.path("word_bpe_49k.json")
    words, tokenizer, rng = cutting_stock.Words(path), Tokenizer.from_file(path), random.Random(5)
    letters = [chr(c) for c in range(0x41, 0x180) if cutting_stock.LETTERS.fullmatch(chr(c))]
    text = " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) + rng.choice(["", ",", "."]) for _ in range(5000)) + " ".join(letters)
    assert words.straight
    assert np.frombuffer(words.encode(text), words.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_words_are_cut_off_from_what_follows():
    """Latin letters are remembered without the marks behind them, whichever these are; tasks of a worker share what they met."""
    path = public_tokenizers.path("word_bpe_49k.json")
    words, tokenizer, rng = cutting_stock.Words(path), Tokenizer.from_file(path), random.Random(6)
    words.encode("chou*** chou### chou's chou12 Chou\x1c chou<|endoftext|>")
    assert "chou" in words.known and not any(w.startswith("chou") and len(w) > 4 for w in words.known)
    behind = [chr(c) for c in range(1, 128) if not chr(c).isalpha()] + ["\u0338", "\u0301", "\u00a0", "\u00df", "\u4e2d", "<|endoftext|>", "'t", "<\u0338", ""]
    text = "".join(rng.choice(["don", "\u00c9t\u00e9", "e", "S", "12", ""]) + rng.choice(behind) + rng.choice(["", "", " ", "\n"]) for _ in range(20_000))
    assert np.frombuffer(words.encode(text), words.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert cutting_stock.words_by(path) is cutting_stock.words_by(path)


def test_knapsack_against_all_patterns():
    rng = np.random.default_rng(2)
    for _ in range(20):
        sizes = np.sort(rng.choice(np.arange(2, 14), 4, replace=False))
        prices, room = rng.random(4), 20
        value, pattern = cutting_stock.knapsack(prices, sizes, room)
        every = itertools.product(*[range(room // s + 1) for s in sizes])
        assert abs(value - max(prices @ p for p in every if sizes @ p <= room)) < 1e-9
        assert abs(pattern @ prices - value) < 1e-9 and pattern @ sizes <= room


def test_program_meets_its_bound():
    rng = np.random.default_rng(3)
    for _ in range(5):
        sizes = np.sort(rng.choice(np.arange(3, 60), 12, replace=False))
        demand = rng.integers(1, 500, 12).astype(float)
        patterns, shares, bound = cutting_stock.column_generation(sizes, demand, 64, gap=1e-6)
        assert all(p @ sizes <= 64 for p in patterns)
        assert (np.array(patterns).T @ shares >= demand - 1e-6).all()
        # The duality gap closes, so neither is better in any way of solving it.
        assert bound <= shares.sum() <= bound * (1 + 1e-5) and bound >= demand @ sizes / 64 - 1e-6


def test_plan_places_every_tail_once():
    rng = random.Random(9)
    counts = {s: rng.randrange(1, 300) for s in rng.sample(range(1, 513), 200)}
    planned, bound = cutting_stock.plan(counts, 512)
    taken = defaultdict(int)
    for pattern, times in planned:
        assert sum(s * n for s, n in pattern.items()) <= 512
        for s, n in pattern.items():
            taken[s] += n * times
    sequences = sum(times for _, times in planned)
    assert taken == counts and sequences <= 1.01 * bound + 5
    places = cutting_stock.Places(planned, 513)
    classes = np.array([s for s, n in counts.items() for _ in range(n)])
    ranks = np.array([r for n in counts.values() for r in range(n)])
    sequence, slot = places.of(classes, ranks)
    assert len(set(zip(sequence.tolist(), slot.tolist()))) == len(classes) and sequence.max() + 1 == sequences == places.sequences
    load = np.bincount(sequence, weights=classes)
    assert load.max() <= 512
