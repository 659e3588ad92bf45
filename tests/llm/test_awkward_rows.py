"""Every operator on awkward rows and on empty tables: as many rows as it promises, and no crash."""

import pytest
from pyspark.sql import functions as F

from hourtide.llm import decontaminate, grace_dedup, hilbert, licences, mixing, packing, pitman_yor, simhash, toxicity

PER_ROW = {
    "exact": lambda df, labels, items: grace_dedup.exact_dedup(df, table_bytes=1000),
    "near": lambda df, labels, items: simhash.near_groups(df),
    "shards": lambda df, labels, items: hilbert.shard_by_curve(df, dimensions=("source", "lang", "size")),
    "scores": lambda df, labels, items: pitman_yor.lm_scores(df, block_tokens=100, bucket_entries=1000),
    "contamination": lambda df, labels, items: decontaminate.contamination(df, items),
    "toxicity": lambda df, labels, items: toxicity.toxicity(df, labels),
    "mix": lambda df, labels, items: mixing.mix_report(df),
    "licences": lambda df, labels, items: licences.scan_licences(df),
}
SUBSETS = {
    "near": lambda df, labels, items: simhash.near_dedup(df),
    "contamination": lambda df, labels, items: decontaminate.clean(df, items),
    "toxicity": lambda df, labels, items: toxicity.clean(df, labels),
    "mix": lambda df, labels, items: mixing.mix(df),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_row(awkward, labels, benchmark, name):
    found = PER_ROW[name](awkward, labels, benchmark)
    ids = sorted(str(r["doc_id"]) for r in found.select("doc_id").collect())
    assert ids == sorted(str(r["doc_id"]) for r in awkward.select("doc_id").collect())


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_tables(awkward, labels, benchmark, name):
    none = awkward.where("false")
    assert PER_ROW[name](none, labels.where("false"), benchmark.where("false")).count() == 0


@pytest.mark.parametrize("name", SUBSETS)
def test_filters_keep_the_columns(awkward, labels, benchmark, name):
    kept = SUBSETS[name](awkward, labels, benchmark)
    assert kept.dtypes == awkward.dtypes
    assert kept.count() <= (3 if name == "mix" else 1) * awkward.count()


def test_results_on_awkward_rows(awkward, labels, benchmark):
    exact = {(r["doc_id"], r["kept"]): r for r in grace_dedup.exact_dedup(awkward).collect()}
    alike = exact[(1, False)]
    # Three repeated rows, one of them with more blanks and no id, one without blanks between.
    assert alike["group_size"] == 5 and exact[(None, True)]["keep_id"] is None
    assert exact[(4, True)]["group_size"] == 4 and exact[(2, False)]["keep_id"] == 4
    near = {r["doc_id"]: r for r in simhash.near_groups(awkward).collect()}
    assert near[3]["fingerprint"] == "0" * 16 and near[3]["component_id"] == 2 == near[4]["component_id"]
    hit = {r["doc_id"]: r for r in decontaminate.contamination(awkward, benchmark).where("doc_id <> 7").collect()}
    assert (hit[1]["n_words"], hit[1]["n_hit"], hit[1]["n_items"], hit[1]["contaminated"]) == (4, 4, 2, True)
    assert hit[5]["n_hit"] == 80_000 - 1 and hit[5]["n_items"] == 1 and hit[6]["n_hit"] == 0 == hit[2]["n_words"]
    scores = [r["score"] for r in toxicity.toxicity(awkward, labels).collect()]
    assert all(0 <= s <= 1 for s in scores)
    assert toxicity.toxicity(awkward, labels.where("false")).where("predicted = 1").count() == 0
    copies = mixing.mix(awkward).groupBy("doc_id").count().where(F.col("doc_id") == 3).collect()
    assert not copies or copies[0]["count"] <= 3
    words = {r["doc_id"]: r for r in licences.scan_licences(awkward).collect()}
    assert words[2]["licences"] == "" == words[3]["sentence_ids"]
