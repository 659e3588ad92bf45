"""A corpus from documents to packed token ids: ``run`` applies the stages to the table ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return
the columns of ``documents``. Between stages the rows are written to the shared folder and read back.

In every stage null texts count as empty, columns beyond id, text and source pass through whatever their names, and an empty
table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourtide.llm import decontaminate, mixing, packing, simhash, toxicity
from hourtide.llm.common import stage, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the examples are labelled documents among those given. Texts without a term of the
    examples stay, empty ones too. Rows of one id are told apart by their text; repeated rows stay or go together."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest id stays: of repeated rows one, of texts that share an id the
    first by hash, of rows without an id one where the component has no other. Empty texts are one component."""
    return simhash.near_dedup(docs)


def reject_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words the benchmark's windows hit one in twenty or more go. Empty texts, and all where no item has
    a word, stay; repeated rows stay or go together."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that the sources' words come near their targets. Documents without words follow
    floor(rate); rows of one id are decided alike, and rows without an id by their text. Null sources are one."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in rows of one length. Repeated rows are packed again, and an empty text is one token."""
    return packing.pack_tokens(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("near copies", one_of_near_copies),
    ("benchmark", reject_contaminated),
    ("mix", mix_sources),
    ("packing", pack),
]

#: The toxicity model, fingerprints and token ids are not SQL; a test follows the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"after-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
