"""Exact deduplication by Grace hashing over complete contents.

1. Every map task puts its rows' normalised contents into an open-addressing table. A row whose content
   the table holds joins the record of the first such row; only first rows carry their content further. A
   table that has grown to its bound is closed and a new one begun. So the copies of one text, however
   many, leave a task as one record (one per table), and rows move on without their texts.
2. Records are partitioned by leading bits of the content's hash. The buckets' sizes are counted over
   distinct hashes; the buckets above the bound are partitioned again by further bits, and so on, until
   each fits or holds one hash only. The contents then move once, to the files of their final buckets:
   the shuffle's files are the spill files.
3. One bucket at a time goes through an open-addressing table that compares complete contents, and
   records of equal contents get one class. Equal hashes of different contents stay apart.

Counts and the row to keep are aggregated per record, then per class, and joined back by record, so a
class with a third of all rows meets other tasks as one row per table that saw it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourtide.llm.common import renamed, stage

#: Normalisation deletes these bytes: the blank and x09 to x0D.
DELETED = b" \t\n\x0b\x0c\r"
TABLE_BYTES = 32 << 20
MORE_BITS = 4
HASH_BITS = 64


class ContentTable:
    """Open addressing with linear probing; an entry is found by its hash and its complete content."""

    def __init__(self) -> None:
        self.slots = [-1] * 64
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def place(self, hashed: int, content: bytes) -> tuple[int, bool]:
        """The entry's number, and whether it is new."""
        at = self._probe(hashed, content)
        if self.slots[at] >= 0:
            return self.slots[at], False
        entry = self.slots[at] = len(self.contents)
        self.hashes.append(hashed)
        self.contents.append(content)
        self.bytes += len(content) + 64
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return entry, True

    def _probe(self, hashed: int, content: bytes) -> int:
        mask = len(self.slots) - 1
        at = hashed & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == hashed and self.contents[entry] == content:
                return at
            at = (at + 1) & mask
        return at

    def _grow(self) -> None:
        mask = 4 * len(self.slots) - 1
        slots = [-1] * (mask + 1)
        for entry, hashed in enumerate(self.hashes):
            at = hashed & mask
            while slots[at] >= 0:
                at = (at + 1) & mask
            slots[at] = entry
        self.slots = slots


def _signed(hashed: int) -> int:
    return hashed - (1 << 64) if hashed >> 63 else hashed


def _records(table_bytes: int, batches: Iterator[pa.RecordBatch], hash_of=None) -> Iterator[pa.RecordBatch]:
    """Step 1. Row and record numbers hold the task's number, so they are unique and a task that runs
    again gives the same ones."""
    first = TaskContext.get().partitionId() << 36
    seen, record, found = 0, 0, ContentTable()
    record_of: list[int] = []
    for batch in batches:
        texts = pc.fill_null(batch.column(1), "")
        rows = {name: [] for name in ("sha", "hash", "record", "content", "n_bytes")}
        for text in texts.cast(pa.binary()).to_pylist():
            content = text.translate(None, DELETED)
            sha = hashlib.sha256(content)
            hashed = int.from_bytes(sha.digest()[:8], "big")
            if found.bytes > table_bytes:
                found, record_of = ContentTable(), []
            entry, new = found.place(hashed, content)
            if new:
                record_of.append(first + record)
                record += 1
            rows["sha"].append(sha.hexdigest())
            rows["hash"].append(_signed(hashed))
            rows["record"].append(record_of[entry])
            rows["content"].append(content if new else None)
            rows["n_bytes"].append(len(content) if new else None)
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(first + seen, first + seen + n), pa.int64()),
                batch.column(0),
                pc.utf8_length(texts).cast(pa.int64()),
                pa.array(rows["sha"], pa.string()),
                pa.array(rows["hash"], pa.int64()),
                pa.array(rows["record"], pa.int64()),
                pa.array(rows["n_bytes"], pa.int64()),
                pa.array(rows["content"], pa.binary()),
            ],
            ["row", "doc_id", "n_chars", "text_sha256", "hash", "record", "n_bytes", "content"],
        )
        seen += n


def _bits(bits: int):
    """The leading bits of the hash, as a number."""
    return F.shiftrightunsigned("hash", HASH_BITS - bits) if bits else F.lit(0).cast("bigint")


def bucketed(records: DataFrame, table_bytes: int) -> DataFrame:
    """Step 2: (hash, bits, bucket), the final bucket of each distinct hash; or the records themselves
    with these columns if the first partitioning is enough."""
    sizes = stage(records.groupBy("hash").agg(F.max("n_bytes").alias("n_bytes")), "hash-sizes")
    total = sizes.agg(F.sum(F.col("n_bytes") + 64)).first()[0] or 0
    bits = min(HASH_BITS, max(0, math.ceil(math.log2(max(1.0, 2 * total / table_bytes)))))
    placed, rest = [], sizes
    while True:
        here = rest.withColumn("bits", F.lit(bits)).withColumn("bucket", _bits(bits))
        over = (
            here.groupBy("bits", "bucket")
            .agg(F.sum(F.col("n_bytes") + 64).alias("bytes"), F.count(F.lit(1)).alias("n"))
            .where((F.col("bytes") > table_bytes) & (F.col("n") > 1))
            .select("bits", "bucket")
        )
        over = stage(over, "large-buckets")
        if bits == HASH_BITS or over.isEmpty():
            placed.append(here)
            break
        placed.append(here.join(over, ["bits", "bucket"], "left_anti"))
        rest = here.join(over, ["bits", "bucket"], "left_semi").select("hash", "n_bytes")
        bits = min(HASH_BITS, bits + MORE_BITS)
    if len(placed) == 1:
        return records.withColumn("bits", F.lit(bits)).withColumn("bucket", _bits(bits))
    leaves = placed[0]
    for more in placed[1:]:
        leaves = leaves.unionByName(more)
    return records.join(leaves.select("hash", "bits", "bucket"), "hash")


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3 over rows sorted by bucket: the class is the smallest record number of equal contents."""
    current, found, members = None, ContentTable(), []

    def out() -> pa.RecordBatch:
        records = [r for group in members for r in group]
        classes = [c for group in members for c in [min(group)] * len(group)]
        return pa.RecordBatch.from_arrays([pa.array(records, pa.int64()), pa.array(classes, pa.int64())], ["record", "class"])

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(5)]
        for bits, bucket, hashed, record, content in zip(*columns):
            if (bits, bucket) != current:
                if members:
                    yield out()
                current, found, members = (bits, bucket), ContentTable(), []
            entry, new = found.place(hashed & (1 << 64) - 1, content)
            if new:
                members.append([])
            members[entry].append(record)
    if members:
        yield out()


def exact_dedup(df: DataFrame, id: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256, n_chars.

    Texts are equal when identical after deleting blanks and x09-x0D; a null text counts as empty. Of
    equal texts the row with the most code points in the original text stays, then the smallest id (a null
    id comes last), then the first row read: of repeated rows exactly one is kept. Other columns are not
    read. An empty table gives no rows. ``table_bytes`` bounds a table of contents; a single content may
    exceed it. Jobs run when this is called: records and bucket sizes are written to the shared folder.
    """
    rows = renamed(df, doc_id=id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = f"row bigint, doc_id {kind}, n_chars bigint, text_sha256 string, hash bigint, record bigint, n_bytes bigint, content binary"
    read = stage(rows.mapInArrow(lambda batches: _records(table_bytes, batches), shape), "records")
    records = read.where(F.col("n_bytes").isNotNull()).select("record", "hash", "n_bytes", "content")
    buckets = bucketed(records, table_bytes).select("bits", "bucket", "hash", "record", "content")
    dealt = buckets.repartition("bits", "bucket").sortWithinPartitions("bits", "bucket")
    classes = dealt.mapInArrow(_classes, "record bigint, class bigint")

    order = F.struct((-F.col("n_chars")).alias("shortness"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    per_record = read.groupBy("record").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("best"))
    labelled = stage(per_record.join(classes, "record"), "record-classes")
    per_class = labelled.groupBy("class").agg(F.sum("n").alias("group_size"), F.min("best").alias("best"))
    kept = labelled.select("record", "class").join(per_class, "class").select("record", "group_size", "best")
    return (
        read.select("record", "row", "doc_id", "n_chars", "text_sha256")
        .join(kept, "record")
        .select(
            "doc_id",
            F.col("best.doc_id").alias("keep_id"),
            "group_size",
            (F.col("row") == F.col("best.row")).alias("kept"),
            "text_sha256",
            "n_chars",
        )
    )
