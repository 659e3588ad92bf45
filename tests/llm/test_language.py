"""Packing, language model, toxicity, decontamination, mixing, and the pipeline, against plain versions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hourtide.llm import decontaminate, mixing, packing, pitman_yor, toxicity
from tests_llm_plain import near_kept

BETWEEN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- packing ----------------------------------------------------------------------------------------


def test_best_fit_takes_the_fullest_row_that_holds():
    rng = random.Random(2)
    lengths = [rng.randint(0, 100) for _ in range(2000)]
    rows = packing.best_fit(lengths, 100)
    free = []
    for piece in sorted(range(len(lengths)), key=lambda p: -lengths[p]):
        fits = [i for i, room in enumerate(free) if room >= lengths[piece]]
        if fits:
            at = min(fits, key=lambda i: free[i])
            free[at] -= lengths[piece]
        else:
            free.append(100 - lengths[piece])
    assert sorted(100 - sum(lengths[p] for p in row) for row in rows) == sorted(free)
    assert sorted(p for row in rows for p in row) == list(range(2000))


def unpacked(rows, row_tokens, width="<u2"):
    pieces = defaultdict(dict)
    for r in rows:
        ids = np.frombuffer(r["ids"], dtype=width)
        assert len(ids) == row_tokens and r["cu_seqlens"][-1] == r["n_tokens"] and r["position_resets"] == r["cu_seqlens"][:-1]
        assert (ids[r["n_tokens"] :] == packing.END_ID).all()
        for i, (doc_id, offset) in enumerate(zip(r["doc_ids"], r["piece_offsets"])):
            assert offset not in pieces[doc_id]
            pieces[doc_id][offset] = ids[r["cu_seqlens"][i] : r["cu_seqlens"][i + 1]].tolist()
    return {doc_id: [t for offset in sorted(p) for t in p[offset]] for doc_id, p in pieces.items()}


def test_packed_rows_give_the_texts_back(documents):
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    rows = packing.pack_tokens(documents.repartition(3), row_tokens=256, group_tokens=20_000).collect()
    assert len({r["row_id"] for r in rows}) == len(rows)
    ids = unpacked(rows, 256)
    bpe = packing.encoder(packing.VOCABULARY)
    assert all(tokens[-1] == packing.END_ID for tokens in ids.values())
    assert {i: bpe.decode(tokens[:-1]) for i, tokens in ids.items()} == texts
    full = sum(r["n_tokens"] for r in rows) / (256 * len(rows))
    assert full > 0.9


# --- language model ---------------------------------------------------------------------------------


def split_of(doc_id, divisor):
    return zlib.crc32(str(doc_id).encode()) % divisor


def tokens_of(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", lower_ascii(text)) if w] + [None]


def test_counts_and_base_score_equal_plain_ones(documents):
    texts = {r["doc_id"]: tokens_of(r["text"]) for r in documents.collect()}
    counts = Counter(w for i, words in texts.items() if split_of(i, 10) for w in words)
    n, v = sum(counts.values()), len(counts)
    found = pitman_yor.lm_scores(documents.repartition(2), block_tokens=5000, bucket_entries=20_000).collect()
    assert len(found) == len(texts)
    held = [0.0, 0.0]
    for r in found:
        words = texts[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(w in counts for w in words), n)
        assert r["held_out"] == (split_of(r["doc_id"], 10) == 0)
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        if r["held_out"]:
            held[0] += r["base_score"]
            held[1] += r["score"]
    assert held[1] > held[0]


def test_texts_share_the_whole_probability(spark):
    """Over all texts of up to ten words of a vocabulary of two the probabilities add up to nearly one:
    what is missing are longer texts and those with unknown words."""
    rng = random.Random(4)
    learned = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 3)))) for i in range(2000) if split_of(i, 10)]
    asked = ["".join(x) for n in range(11) for x in itertools.product("ab", repeat=n)]
    held = [i for i in range(10_000, 60_000) if not split_of(i, 10)][: len(asked)]
    df = spark.createDataFrame(learned + [(i, " ".join(t)) for i, t in zip(held, asked)], "doc_id bigint, text string")
    for hot_share in (1.0, 0.001):
        found = pitman_yor.lm_scores(df, hot_share=hot_share, block_tokens=3000, bucket_entries=4000)
        whole = found.where("held_out").agg(F.sum(F.pow(F.lit(10.0), "score"))).first()[0]
        assert 0.95 < whole < 1 + 1e-9
    again = {r["doc_id"]: r["score"] for r in found.collect()}
    assert again == {r["doc_id"]: r["score"] for r in pitman_yor.lm_scores(df, hot_share=0.001, block_tokens=3000, bucket_entries=4000).collect()}


def plain_seating(customers, parent, law, sweeps, rng):
    """One customer at a time over explicit tables: the mean number of tables per dish."""
    d, s = law
    tables = {w: [c] for w, c in customers.items()}
    kept = Counter()
    for sweep in range(sweeps):
        for w, c in customers.items():
            for _ in range(c):
                at = rng.choices(range(len(tables[w])), weights=tables[w])[0]
                tables[w][at] -= 1
                if not tables[w][at]:
                    tables[w].pop(at)
                new = (s + d * sum(map(len, tables.values()))) * parent[w]
                weights = [n - d for n in tables[w]] + [new]
                at = rng.choices(range(len(weights)), weights=weights)[0]
                if at == len(tables[w]):
                    tables[w].append(0)
                tables[w][at] += 1
            if sweep >= sweeps // 4:
                kept[w] += len(tables[w]) / (sweeps - sweeps // 4)
    return kept


@pytest.mark.parametrize("law", [(0.75, 2.0), (0.4, 5.0)])
def test_seatings_follow_plain_gibbs_sampling(law):
    customers = {0: 40, 1: 5, 2: 1, 3: 300, 4: 2}
    parent = {0: 0.3, 1: 0.05, 2: 0.001, 3: 0.6, 4: 0.04}
    rng = np.random.default_rng(1)
    many = 300
    wide = np.tile(np.array([customers[i] for i in range(5)]), many)
    restaurant = np.repeat(np.arange(many), 5)
    kept = pitman_yor.seatings(wide, restaurant, np.ones(many), np.tile([parent[i] for i in range(5)], many), law, rng, 2, 20)
    mean = np.mean([t.reshape(many, 5).mean(axis=0) for t, _ in kept], axis=0)
    plain = plain_seating(customers, parent, law, 300, random.Random(2))
    print(mean, plain)
    assert mean[2] == 1 and all(mean[i] == pytest.approx(plain[i], rel=0.15) for i in range(5))


def test_arrays_survive_transit():
    rng = np.random.default_rng(3)
    for values in (rng.integers(0, 1 << 63, 1000, dtype=np.uint64), np.array([0, (1 << 64) - 1], dtype=np.uint64), np.zeros(0, dtype=np.uint64)):
        assert (pitman_yor.unpack(pitman_yor.pack(np.sort(values), True)) == np.sort(values)).all()
        assert (pitman_yor.unpack(pitman_yor.pack(values)).view(np.uint64) == values).all()


# --- toxicity ---------------------------------------------------------------------------------------


def test_counts_of_terms_follow_from_words_met(spark, monkeypatch):
    """The counts are those of each word's terms, also when words met are forgotten; tasks of a worker share them."""
    rng = random.Random(4)
    words = ["", "a", "Hello", "hello1there", "hellos", "helloes", "\u00e9t\u00e9s\u4e2d\u6587\u5b57", "\u00e9t\u00e9s\u4e2d\u6587", "x", "wonderful", "wonders"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(12))) for _ in range(40)] + ["", "  "]
    every = sorted({t for w in words for t in toxicity.terms_of(w.lower()) if t and t[0] != "x"} - {"hellos"})
    numbers = {t: n for n, t in enumerate(every)}
    sent = spark.sparkContext.broadcast(numbers)
    assert toxicity.terms_by(sent) is toxicity.terms_by(sent)
    monkeypatch.setattr(toxicity, "REMEMBERED", 3)
    for known in (toxicity.terms_by(sent), toxicity.Terms({})):
        plain = [(i, n, float(c)) for i, text in enumerate(texts) for n, c in sorted(Counter(known.numbers[t] for w in toxicity.words_of(text) for t in toxicity.terms_of(w) if t in known.numbers).items())]
        assert list(zip(*(a.tolist() for a in known.counts(texts)))) == plain


def test_index_is_exact():
    rng = np.random.default_rng(5)
    idf = rng.random(40) + 0.5
    entries = []
    for i in range(700):
        terms = tuple(sorted(rng.choice(40, rng.integers(1, 6), replace=False).tolist()))
        entries.append((terms, tuple(rng.integers(1, 4, len(terms)).tolist()), 1, int(rng.integers(0, 2)), i))
    matrix = np.zeros((len(entries), 40))
    for e in entries:
        v = np.zeros(40)
        v[list(e[0])] = (1 + np.log(e[1])) * idf[list(e[0])]
        matrix[e[4]] = v / np.linalg.norm(v)
    queries = [(tuple(sorted(rng.choice(40, 4, replace=False).tolist())), rng.integers(1, 4, 4)) for _ in range(60)]
    place, terms, counts = np.repeat(np.arange(60), 4), np.concatenate([q[0] for q in queries]), np.concatenate([q[1] for q in queries])
    index = toxicity.BlockMaxIndex(idf, entries)
    for light in (0.0, 0.05, 0.5, 0.9):
        for (own, times), (numbers, cosines) in zip(queries, index.nearest(place, terms, counts, 60, 10, light)):
            query = np.zeros(40)
            query[list(own)] = (1 + np.log(times)) * idf[list(own)]
            exact = matrix @ query / np.linalg.norm(query)
            plain = np.sort(exact)[::-1][:10]
            assert cosines == pytest.approx(plain[plain > 0], abs=1e-9)
            assert exact[[index.ids[i] for i in numbers]] == pytest.approx(cosines, abs=1e-8)


def test_frequent_terms_are_not_looked_up_one_by_one(monkeypatch):
    """Texts of terms that half the entries have touch none of their postings, and the search stays exact: with a
    matrix of all, some or none of the terms, postings in small pieces, and entries of equal cosines."""
    rng = np.random.default_rng(6)
    idf = rng.random(60) + 0.5
    entries = [(tuple(np.sort(rng.choice(60, 30, replace=False)).tolist()), tuple(rng.integers(1, 4, 30).tolist()), 1, i % 2, i) for i in range(640)]
    entries += [(*e[:2], 1, 1, 1000 + e[4]) for e in entries[:30]]
    matrix = np.zeros((len(entries), 60))
    for row, (terms, counts, *_) in zip(matrix, entries):
        row[list(terms)] = (1 + np.log(counts)) * idf[list(terms)]
    matrix /= np.linalg.norm(matrix, axis=1)[:, None]
    counts = rng.integers(0, 3, (32, 60))
    counts[0], counts[1] = 0, np.arange(60) == 7
    place, terms = np.nonzero(counts)
    texts = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0.0) * idf
    exact = matrix @ (texts / np.maximum(np.linalg.norm(texts, axis=1), 1e-9)[:, None]).T
    numbers, touched, runs = {e[4]: i for i, e in enumerate(entries)}, [], toxicity.runs_of
    monkeypatch.setattr(toxicity, "runs_of", lambda starts, lengths: touched.append(int(lengths.sum())) or runs(starts, lengths))

    def holds(index, light):
        for text, (near, cosines) in enumerate(index.nearest(place, terms, counts[place, terms], 32, 10, light)):
            plain = np.sort(exact[:, text])[::-1][:10]
            assert cosines == pytest.approx(plain[plain > 0], abs=1e-9)
            assert exact[[numbers[index.ids[i]] for i in near], text] == pytest.approx(cosines, abs=1e-8)
            assert (np.lexsort((near, -cosines)) == np.arange(len(near))).all()

    holds(toxicity.BlockMaxIndex(idf, entries), 0.03)
    # Every posting of these texts is some 350,000.
    assert sum(touched) < 50_000
    monkeypatch.setattr(toxicity, "POSTINGS", 1000)
    for cells in (1 << 22, 20 * len(entries), 0):
        monkeypatch.setattr(toxicity, "MOST_CELLS", cells)
        for light in (0.0, 0.05, 0.5, 0.95):
            holds(toxicity.BlockMaxIndex(idf, entries), light)


def plain_scores(docs, labels):
    """The whole score with a dictionary per text and every example compared."""
    examples = sorted((i for i in labels if split_of(i, 4) != 2 and i in docs))
    held = [Counter(w for x in toxicity.words_of(docs[i] or "") for w in toxicity.terms_of(x)) for i in examples]
    toxic = [labels[i] for i in examples]
    seen, bad = Counter(), Counter()
    for k, y in zip(held, toxic):
        seen.update(k.keys())
        bad.update(k.keys() if y else ())
    used = {t for t, n in seen.items() if n > 1 or not t.endswith("*")}
    counted = {i: Counter(w for x in toxicity.words_of(t or "") for w in toxicity.terms_of(x)) for i, t in docs.items()}
    frequency = Counter(t for k in counted.values() for t in k if t in used)
    share = sum(toxic) / len(toxic)
    logit = lambda p: np.log(p / (1 - p))
    weight = {}
    for t in used:
        away = logit((bad[t] + 20 * share) / (seen[t] + 20)) - logit(share)
        weight[t] = (away**2 if abs(away) > 1e-9 else 0.0) * (np.log((1 + len(docs)) / (1 + frequency[t])) + 1)

    def vector(k):
        v = {t: (1 + np.log(n)) * weight[t] for t, n in k.items() if t in used and weight[t] > 0}
        size = np.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()}

    entries = {}
    for k, y in zip(held, toxic):
        v = vector(k)
        if v:
            e = entries.setdefault(tuple(sorted((t, n) for t, n in k.items() if t in used)), [v, 0, 0])
            e[1], e[2] = e[1] + 1, e[2] + y
    prior, scores = min(0.1, (sum(toxic) + 0.1) / (len(toxic) + 1)), {}
    for i, k in counted.items():
        v = vector(k)
        near = sorted(((sum(x * e[0].get(t, 0) for t, x in v.items()), e[1], e[2]) for e in entries.values()), reverse=True)
        near = [(min(c, 1.0), n, b) for c, n, b in near if c > 1e-9]
        edge = near[9][0] - near[10][0] if len(near) > 10 else 1
        votes = [(n * c * c / (1.1 - c), b / n) for c, n, b in near[:10]]
        score = (sum(v * s for v, s in votes) + prior) / (sum(v for v, _ in votes) + 1) if votes else 0.1 / (len(toxic) + 1)
        scores[i] = (score, edge)
    return scores


def test_whole_score_equals_a_plain_one(spark, sf_dir, documents):
    docs = {r["doc_id"]: r["text"] for r in documents.collect()} | {-1: None, -2: "", -3: "Idiot idiot CLOWN x"}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    frame = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string").repartition(5)
    found = {r["doc_id"]: r["score"] for r in toxicity.toxicity(frame, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    expected = plain_scores(docs, labels)
    # Where the tenth neighbour is a matter of rounding, either will do.
    sure = [i for i, (_, edge) in expected.items() if edge > 1e-8]
    assert len(sure) > 0.9 * len(docs)
    assert [found[i] for i in sure] == pytest.approx([expected[i][0] for i in sure], abs=1e-6)


def test_held_out_labels_are_predicted(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.toxicity(documents, labels)
    truth = {r["doc_id"]: r["toxic"] for r in labels.where("toxic is not null").collect()}
    rows = [r for r in scored.collect() if r["doc_id"] in truth]
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if split_of(i, 4) == 2}
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held)
    toxic = [r["predicted"] for r in held if truth[r["doc_id"]] == 1]
    assert right > 0.93 and sum(toxic) / len(toxic) > 0.6


def test_held_out_labels_do_not_matter(documents, spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(4)) == 2
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [{r["doc_id"]: r["score"] for r in toxicity.toxicity(documents, x).collect()} for x in (labels, turned)]
    assert scores[0] == scores[1]


def labelled(spark, texts):
    """Documents (text, toxic or None), ids outside the held-out fold, and their labels."""
    ids = [i for i in range(1, 1000) if split_of(i, 4) != 2][: len(texts)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in zip(ids, texts)], "doc_id bigint, text string")
    labels = [(i, x) for i, (_, x) in zip(ids, texts) if x is not None]
    return docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"), ids


def test_few_examples_give_terms(spark):
    """Four toxic examples among forty, and a word in a third of the toxic half of sixty."""
    for n, toxic, marked in ((40, 4, 4), (60, 30, 10)):
        texts = [("plain words scum here" if i < marked else f"plain words w{chr(97 + i % 26)} here", int(i < toxic)) for i in range(n)]
        docs, labels, ids = labelled(spark, texts + [("scum of another sort", None)])
        found = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(docs, labels).collect()}
        assert all(found[i] for i in ids[:marked]) and found[ids[-1]] == 1


def test_toxic_documents_leave_a_small_corpus(spark, sf_dir, documents):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 1").select("doc_id")
    kept = corpus_pipeline.reject_toxic(spark, documents, sf_dir).join(labels, "doc_id", "left_semi").count()
    assert kept <= documents.join(labels, "doc_id", "left_semi").count() / 2


def test_texts_without_terms_stay(spark):
    """Labels of one kind, and a balanced table in which most toxic examples have no term."""
    docs, labels, ids = labelled(spark, [(f"words {i} of any kind", 1) for i in range(30)])
    assert {r["doc_id"] for r in toxicity.clean(docs, labels).collect()} == set(ids)
    texts = [("plain scum words" if i < 10 else "plain words", int(i < 30)) for i in range(60)] + [("plain words", None), (None, None)]
    docs, labels, ids = labelled(spark, texts)
    assert {r["doc_id"] for r in toxicity.clean(docs, labels).collect()} == set(ids[10:])
    assert toxicity.toxicity(docs, labels).agg(F.min("score")).first()[0] < 0.01


# --- decontamination --------------------------------------------------------------------------------


def plain_contamination(texts, items, window=13):
    windows = defaultdict(set)
    for item, text in items:
        words = BETWEEN.findall(lower_ascii(text))
        n = min(window, len(words))
        for i in range(len(words) - n + 1) if words else ():
            windows[tuple(words[i : i + n])].add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for doc_id, text in texts:
        words = BETWEEN.findall(lower_ascii(text))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (owners := windows.get(tuple(words[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= owners
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc_id] = (len(words), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(words))
    return out


def test_contamination_equals_brute_force(spark, documents, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    known = [(r["item_id"], r["text"]) for r in items.collect()]
    # Shared passages, an item of a frequent word, overlaps, and lower case by A-Z only.
    known += [(901, "the"), (902, " ".join(texts[0][1].split()[3:40])), (903, "É1 K2"), (904, "the of"), (905, texts[1][1])]
    texts += [(9001, "é1 k2 É1 K2 xÉ1 K2"), (9002, "É1-k2, The  of"), (9003, texts[0][1] + " " + texts[0][1])]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    bench = spark.createDataFrame(known, "item_id bigint, text string")
    expected = plain_contamination(texts, known)
    for block_bytes in (1 << 24, 20_000):
        rows = decontaminate.contamination(docs, bench, block_bytes=block_bytes).collect()
        found = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows}
        assert found == expected
    kept = {r["doc_id"] for r in decontaminate.clean(docs, bench).select("doc_id").collect()}
    assert kept == {i for i, r in expected.items() if not r[4]}


# --- mixing -----------------------------------------------------------------------------------------


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Share by weight, cut what is above, share the excess among the others, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    left = float(total)
    while open_ and left > 1e-9:
        share = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if target[s] + share * weight[s] >= most * sizes[s]]
        if not above:
            for s in open_:
                target[s] += share * weight[s]
            break
        for s in above:
            left -= most * sizes[s] - target[s]
            target[s] = float(most * sizes[s])
            open_.discard(s)
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 1000, None: 5}, {"a": 1, "b": 1, "c": 900}, {"x": 7}, {"a": 0, "b": 5, "é": 50, "z": 500}])
def test_targets_equal_repeated_sharing(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
    found = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    assert found == pytest.approx(plain_targets(sizes))


def test_mix_comes_near_targets_and_copies_whole_rows(spark):
    df = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"), F.lit("one two  three").alias("text")
    )
    report = mixing.mix_report(df)
    sums = report.join(df.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"))
    assert all(r["taken"] == pytest.approx(r["target"], rel=0.1) for r in sums.collect())
    copies = {r["doc_id"]: r["copies"] for r in report.collect()}
    mixed = {r["doc_id"]: r["count"] for r in mixing.mix(df).groupBy("doc_id").count().collect()}
    assert mixed == {i: n for i, n in copies.items() if n} and max(copies.values()) <= 3


# --- awkward texts and ids ----------------------------------------------------------------------------


@pytest.mark.parametrize("letter", [" ", "\n", "　", "x", "1", ".", "é"])
def test_long_runs_are_encoded_and_come_back(letter):
    bpe = packing.encoder(packing.VOCABULARY)
    for text in (letter * 2_000_000, f"a{letter * 1_500_000}b", f"a {letter * 20_000}  b\n{letter * 12_000}"):
        assert bpe.decode(packing.encode(bpe, text).tolist()) == text


def test_long_blanks_as_in_the_pattern():
    """Around the length from which runs are taken out, ids are those of the whole text."""
    bpe = packing.encoder(packing.VOCABULARY)
    rng = random.Random(7)
    for _ in range(30):
        runs = ["".join(rng.choice(" \n\t \x1c") for _ in range(rng.choice([9_990, 10_000, 12_000]))) for _ in range(2)]
        for text in (f"a{runs[0]}b's{runs[1]}", f"{runs[0]}é {runs[1]}!", " " * rng.choice([9_999, 10_000, 10_001]) + rng.choice(["", "x", "\x1c", "7"])):
            assert packing.encode(bpe, text).tolist() == bpe.encode_ordinary(text)


def test_packing_of_awkward_rows(awkward, spark):
    bpe = packing.encoder(packing.VOCABULARY)
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()] + [(99, " " * 1_200_000), (98, "\n" * 1_000_001 + "end")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = Counter()
    for r in packing.pack_tokens(frame.repartition(3), row_tokens=64).collect():
        ids = np.frombuffer(r["ids"], dtype="<u2")
        for doc_id, begin, end in zip(r["doc_ids"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            found[doc_id, tuple(ids[begin:end].tolist())] += 1
    wanted = Counter()
    for doc_id, text in rows:
        ids = packing.encode(bpe, text or "").tolist() + [packing.END_ID]
        wanted.update((doc_id, tuple(ids[o : o + 64])) for o in range(0, len(ids), 64))
    assert found == wanted
    assert packing.pack_tokens(awkward.where("false")).count() == 0


def plain_mix(rows):
    """Copies of (doc_id, source, text) rows, from the rule as the docstrings have it."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    own = lambda i, t: str(i) if i is not None else "null:" + hashlib.md5((t or "").encode()).hexdigest()
    hashed = [int(hashlib.md5(f"mix-1:{own(i, t)}".encode()).hexdigest()[:13], 16) for i, _, t in rows]
    sizes = Counter()
    for _, s, t in rows:
        sizes[s] += size(t)
    targets, out = plain_targets(sizes), []
    for (i, s, t), h in zip(rows, hashed):
        rate = targets[s] / sizes[s] if sizes[s] else 1.0
        floor = int(rate + 1e-12)
        wanted, at, bound = targets[s] - floor * sizes[s], 0, None
        for d in sorted({g for (_, x, _), g in zip(rows, hashed) if x == s}):
            n = sum(size(u) for (_, x, u), g in zip(rows, hashed) if x == s and g == d)
            if n and at + n / 2 <= wanted + 1e-9:
                bound = d
            at += n
        out.append(floor + (bound is not None and h <= bound and size(t) > 0))
    return out


def test_mix_of_awkward_sources(spark):
    """Sources without words, one that is taken three times whole, rows without ids, and repeated rows."""
    rng = random.Random(11)
    rows = [(None if rng.random() < 0.2 else i, rng.choice(["a", "b", None]), rng.choice(["", None, "x " * rng.randrange(1, 40)])) for i in range(300)]
    rows += [(1000 + i, "empty", rng.choice(["", " \t", None])) for i in range(20)] + [(2000 + i, "small", rng.choice(["", "one word here"])) for i in range(12)]
    rows += [rows[0], rows[0], rows[5]]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    key = lambda r: str((r[0], r[1], r[2]))
    report = mixing.mix_report(frame).select("doc_id", "size", "copies").collect()
    expected = plain_mix(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(str((r["doc_id"], r["size"], r["copies"])) for r in report) == sorted(str((r[0], size(r[2]), n)) for r, n in zip(rows, expected))
    mixed = Counter(key(r) for r in mixing.mix(frame).collect())
    wanted = Counter()
    for r, n in zip(rows, expected):
        wanted[key(r)] += n
    assert mixed == +wanted
    assert all(n == 1 for r, n in zip(rows, expected) if r[1] == "empty") and {n for r, n in zip(rows, expected) if r[1] == "small"} == {3}


# --- the pipeline -----------------------------------------------------------------------------------


def test_stages_take_effect(spark, sf_dir, documents):
    """Each stage against a plain version on the rows its predecessor kept."""
    columns, docs, seen = documents.columns, documents.persist(), []
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for name, apply in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        after = apply(spark, docs, sf_dir)
        if name == "packing":
            ids = [i for r in after.collect() for i, o in zip(r["doc_ids"], r["piece_offsets"]) if o == 0]
            assert Counter(ids) == Counter(r[0] for r in before)
            break
        assert after.columns == columns
        docs = after.persist()
        rows = [tuple(r) for r in docs.collect()]
        assert set(rows) <= set(before)
        kept = {r[0] for r in rows}
        if name == "toxicity":
            labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
            clean = [r[0] for r in before if labels.get(r[0]) == 0]
            assert sum(i in kept for i in clean) >= 0.95 * len(clean)
        if name == "near copies":
            assert kept == near_kept({r[0]: r[1] for r in before})
        if name == "benchmark":
            assert kept == {i for i, r in plain_contamination([r[:2] for r in before], items).items() if not r[4]}
        if name == "mix":
            assert max(Counter(rows).values()) <= 3
        seen.append(name)
    assert seen == ["toxicity", "near copies", "benchmark", "mix"]
