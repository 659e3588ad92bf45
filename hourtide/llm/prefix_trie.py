"""The trie of conversation prefixes, with subtree totals by time-forward processing.

1. Turns get their place by running totals over ranges of (conversation, turn), so that no conversation sits in one
   task; conversations are rebuilt from the first turns of their base and their own later ones.
2. A prefix is named by its depth and the sums of two hashes of its turns and their places. Sums are running
   totals too, so a conversation of any length is spread over tasks. Prefixes with one name are one node.
3. Nodes are dealt to components. What stands under one first turn is a component as long as it has a bounded
   number of turns. Otherwise a component is a run of bounded length along the path of the smallest member, and so
   hangs together too.
4. A shard is a task with whole components. Its nodes come sorted from the deepest level to the top. Each takes the
   totals that its children have put into a priority queue, which spills sorted runs, and puts its own in for its parent.
5. Across the shards the roots of components pass their totals on by doubling pointers, so a path through n components
   takes log n rounds. Components that got totals from others pass them up inside once more.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourtide.llm.common import renamed, stage
from hourtide.operators.ranks import running_totals

WORD = r"[^\x20\x09-\x0D]+"
#: Conversations of one base, and the turns it may lend.
BASE_STEP, MOST_LENT = 20, 4
#: Turns under a first turn that one task takes, and levels of a run along a path.
COMPONENT_TURNS = 1 << 16
RUN_LEVELS = 1 << 12
#: Entries of a queue in memory.
HELD = 1 << 18
#: Bytes of joined numbers in a row.
CHUNK = 1 << 20
ENTRY = struct.Struct("<q16sqq")


class SpillingQueue:
    """Entries (level from below, node, two numbers) in order. What is more than ``held`` goes to a nameless file of
    the task in sorted runs, which are read back a few entries at a time."""

    def __init__(self, held: int = HELD) -> None:
        self.held, self.heap, self.runs = held, [], []

    def push(self, entry: tuple[int, bytes, int, int]) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.held:
            file = tempfile.TemporaryFile()
            for one in sorted(self.heap):
                file.write(ENTRY.pack(*one))
            file.seek(0)
            self.heap = []
            self.runs.append(self._read(file))
            self._next(len(self.runs) - 1)

    @staticmethod
    def _read(file) -> list:
        return [iter(lambda: file.read(ENTRY.size * 1024), b""), iter(()), None]

    def _next(self, run: int) -> None:
        blocks, entries, _ = self.runs[run]
        found = next(entries, None)
        if found is None and (block := next(blocks, None)):
            self.runs[run][1] = entries = ENTRY.iter_unpack(block)
            found = next(entries)
        self.runs[run][2] = found

    def take(self, level: int, node: bytes) -> tuple[int, int]:
        """The sums of the entries of a node; none of those before it are left."""
        first, second = 0, 0
        while self.heap and self.heap[0][:2] == (level, node):
            _, _, a, b = heapq.heappop(self.heap)
            first, second = first + a, second + b
        for run in range(len(self.runs)):
            while (head := self.runs[run][2]) and head[:2] == (level, node):
                first, second = first + head[2], second + head[3]
                self._next(run)
        self.runs = [r for r in self.runs if r[2]]
        return first, second

    def __len__(self) -> int:
        return len(self.heap) + sum(r[2] is not None for r in self.runs)


def _forward(held: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes (id, pid, depth, top, leaves, saved, more columns), the deepest first and by id in a level, with the sums
    over those below them in the task."""
    queue = SpillingQueue(held)
    for batch in batches:
        leaves, saved = [], []
        columns = [batch.column(c).to_pylist() for c in range(6)]
        for node, parent, depth, top, a, b in zip(*columns):
            below = queue.take(-depth, node)
            leaves.append(a + below[0])
            saved.append(b + below[1])
            if not top:
                queue.push((1 - depth, parent, leaves[-1], saved[-1]))
        sums = [pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], *sums, *batch.columns[6:]], batch.schema.names)
    if len(queue):
        raise RuntimeError("totals are left over: the nodes of a shard were not in order")


def pass_up(nodes: DataFrame, held: int = HELD) -> DataFrame:
    """``nodes`` (id, pid, depth, top, leaves, saved, component) with sums over all of their component below them."""
    dealt = nodes.repartition("component").sortWithinPartitions(F.col("depth").desc(), "id")
    return dealt.mapInArrow(lambda batches: _forward(held, batches), nodes.schema)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, number) in order as rows (id, first number, numbers joined by commas, each with one in front)."""
    at, first, text = None, 0, []
    size = 0
    for batch in batches:
        done = []
        for node, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if node != at or size > CHUNK:
                if text:
                    done.append((at, first, "".join(text)))
                at, first, text, size = node, number, [], 0
            text.append(f",{number}")
            size += len(text[-1])
        yield _chunks(done)
    if text:
        yield _chunks([(at, first, "".join(text))])


def _chunks(rows: list[tuple[bytes, int, str]]) -> pa.RecordBatch:
    ids, firsts, texts = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.binary()), pa.array(firsts, pa.int64()), pa.array(texts, pa.string())], ["id", "first", "numbers"]
    )


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each id's numbers, from rows in order."""
    at, digest = None, None

    def out(found: list[tuple[bytes, str]]) -> pa.RecordBatch:
        ids, hashes = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(hashes, pa.string())], ["id", "ends_sha256"])

    for batch in batches:
        found = []
        for node, numbers in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if node != at:
                if digest:
                    found.append((at, digest.hexdigest()))
                at, digest, numbers = node, hashlib.sha256(), numbers[1:]
            digest.update(numbers.encode())
        yield out(found)
    if digest:
        yield out([(at, digest.hexdigest())])


def digests_of_ends(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256) of ``ends`` (id, conv_id): a group's numbers are joined range by range in all tasks; only
    their text then meets, in rows of a megabyte that stream through the digest."""
    ranges = stage(ends, "ends").repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id")
    chunks = ranges.mapInArrow(_joined, "id binary, first bigint, numbers string")
    return chunks.repartition("id").sortWithinPartitions("id", "first").mapInArrow(_digested, "id binary, ends_sha256 string")


def across(tops: DataFrame) -> DataFrame:
    """``tops`` (component, above, pid, leaves, saved, runs) with sums over all components below theirs.

    Only runs have components below them. Each round adds up what the pointers bring and doubles them.
    """
    columns = ["component", "pid", "leaves", "saved"]
    up = F.when(F.col("above") != "root", F.col("above"))
    links = stage(tops.where("runs").select(*columns, up.alias("up")), "links")
    while links.where("up is not null").limit(1).count():
        brought = links.where("up is not null").groupBy("up").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s")).withColumnRenamed("up", "to")
        further = links.where("up is not null").select(F.col("component").alias("over"), F.col("up").alias("next"))
        joined = links.join(brought, F.col("component") == F.col("to"), "left").join(further, F.col("up") == F.col("over"), "left")
        links = joined.select(
            "component",
            "pid",
            (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
            F.col("next").alias("up"),
        )
        links = stage(links, "links")
    return tops.where("not runs").select(*columns).unionByName(links.select(*columns))


def lent(conv_id: Column) -> Column:
    return F.pmod(F.crc32(F.encode(conv_id.cast("string"), "UTF-8")), F.lit(MOST_LENT)).cast("bigint")


def placed_turns(df: DataFrame, id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, pos, digest, words): every turn with its place in its conversation, from 1."""
    rows = renamed(df, conv_id=id, turn=turn, role=role, text=text).where(F.col("conv_id").isNotNull())
    said, spoke = F.coalesce("text", F.lit("")), F.coalesce(F.col("role"), F.lit(""))
    digest = F.sha2(F.concat(F.length(spoke).cast("string"), F.lit(":"), spoke, said), 256)
    place = F.struct("turn", spoke.alias("role"), F.sha2(said, 256).alias("text"))
    n_words = F.regexp_count(said, F.lit(WORD)).cast("bigint")
    each = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), place.alias("place"), digest.alias("digest"), n_words.alias("words"))
    # Turns alike in all come out one after another.
    counted = each.groupBy("conv_id", "place", "digest", "words").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(stage(counted, "turns-counted"), "place", ["n"], ["conv_id"])
    copies = F.explode(F.sequence(F.col("n_before") + 1, F.col("n_before") + F.col("n")))
    return stage(ranked.select("conv_id", copies.alias("pos"), "digest", "words"), "turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id) of all conversations, and (conv_id, pos, digest, words) of their rebuilt turns."""
    lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("length"))
    base = F.col("conv_id") - F.col("conv_id") % BASE_STEP
    convs = stage(lengths.select("conv_id", "length", base.alias("base"), lent(F.col("conv_id")).alias("lent")), "conversations")
    heads = turns.where((F.col("conv_id") % BASE_STEP == 0) & (F.col("pos") < MOST_LENT)).withColumnRenamed("conv_id", "base")
    # At most ``MOST_LENT`` - 1 turns of a base for each of its conversations.
    first = convs.select("conv_id", "base", "lent").join(heads, "base").where(F.col("pos") <= F.col("lent"))
    lenders = convs.where(F.col("conv_id") % BASE_STEP == 0).select(F.col("conv_id").alias("base"), F.col("length").alias("base_length"))
    # Only where the base is shorter than what it should lend, or absent, do the own turns move.
    short = convs.join(lenders.where(F.col("base_length") < MOST_LENT - 1), "base").select("conv_id", "lent", "base_length")
    absent = convs.join(lenders, "base", "left_anti").select("conv_id", "lent", F.lit(0).cast("bigint").alias("base_length"))
    shifts = short.unionByName(absent).select("conv_id", (F.least("lent", "base_length") - F.col("lent")).alias("shift")).where(F.col("shift") < 0)
    own = turns.where(F.col("pos") > lent(F.col("conv_id"))).join(shifts, "conv_id", "left")
    own = own.withColumn("pos", F.col("pos") + F.coalesce("shift", F.lit(0)))
    columns = ["conv_id", "pos", "digest", "words"]
    return convs.select("conv_id"), first.select(*columns).unionByName(own.select(*columns))


def named(depth: Column, first: Column, second: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", depth.cast("string"), first.cast("string"), second.cast("string"))))


def prefixes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, depth, id, pid, first, words, length): a row for each conversation and prefix of it, the root's too.
    ``first`` is the node of the first turn."""
    long = "decimal(20,0)"
    hashed = turns.select(
        "conv_id",
        "pos",
        "words",
        F.xxhash64("pos", "digest").cast(long).alias("a"),
        F.xxhash64("digest", "pos", F.lit("b")).cast(long).alias("b"),
        F.lit(1).cast("bigint").alias("one"),
    )
    none = F.lit(0).cast(long)
    start = F.col("pos") == 1
    hashed = hashed.withColumns({"a_first": F.when(start, F.col("a")).otherwise(none), "b_first": F.when(start, F.col("b")).otherwise(none)})
    summed = running_totals(stage(hashed, "rebuilt"), "pos", ["a", "b", "one", "a_first", "b_first"], ["conv_id"])
    one, before = F.lit(1).cast("bigint"), F.col("pos") - 1
    wide = "decimal(38,0)"

    def sum_of(*parts: str) -> Column:
        total = F.col(parts[0]).cast(wide)
        for part in parts[1:]:
            total = (total + F.col(part).cast(wide)).cast(wide)
        return total

    inner = summed.select(
        "conv_id",
        F.col("pos").alias("depth"),
        named(F.col("pos"), sum_of("a_before", "a"), sum_of("b_before", "b")).alias("id"),
        F.when(before > 0, named(before, sum_of("a_before"), sum_of("b_before"))).otherwise(root_id()).alias("pid"),
        named(one, sum_of("a_first_total"), sum_of("b_first_total")).alias("first"),
        "words",
        F.col("one_total").alias("length"),
    )
    inner = stage(inner, "prefixes")
    # The last turn of each conversation; those without any end at the root.
    lengths = inner.where(F.col("depth") == F.col("length")).select(F.col("conv_id").alias("known"), "length")
    roots = convs.join(lengths, F.col("conv_id") == F.col("known"), "left").select(
        "conv_id",
        F.lit(0).cast("bigint").alias("depth"),
        root_id().alias("id"),
        F.lit(None).cast("binary").alias("pid"),
        F.lit(None).cast("binary").alias("first"),
        F.lit(0).cast("bigint").alias("words"),
        F.coalesce("length", F.lit(0)).cast("bigint").alias("length"),
    )
    return inner.unionByName(roots)


def root_id() -> Column:
    return F.unhex(F.md5(F.lit("root")))


def trie(
    df: DataFrame,
    id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    component_turns: int = COMPONENT_TURNS,
    run_levels: int = RUN_LEVELS,
    held: int = HELD,
) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns come by ``turn``, null first, and among equal ones by role and the SHA-256 of the text; null roles and texts are
    empty. Repeated rows are turns of their own. Rows without a conversation are left out. The base of a conversation
    is its number less its remainder by 20, which has the number's sign. An empty table gives no
    nodes, not even a root. Prefixes count as equal when depth and two sums of 64-bit hashes are. Jobs run when this is called.
    """
    convs, turns = rebuilt(placed_turns(df, id, turn, role, text))
    rows = prefixes(convs, turns)
    nodes = rows.groupBy("id").agg(
        F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.min("pid").alias("pid"),
        F.min("first").alias("first"),
        F.max("words").alias("words"),
        F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("turns"),
    )
    nodes = stage(nodes, "nodes")
    heavy = nodes.where((F.col("depth") == 1) & (F.col("turns") > component_turns)).select(F.col("id").alias("heavy"))
    parents = nodes.where(F.col("depth") > 0).select(F.col("id").alias("pid"), F.col("conv_id").alias("parent"))
    children = nodes.where("pid is not null").groupBy("pid").agg(F.count(F.lit(1)).alias("n_children")).withColumnRenamed("pid", "cid")
    smallest = nodes.where("depth = 0").agg(F.min("conv_id")).scalar()
    joined = (
        nodes.join(heavy, F.col("first") == F.col("heavy"), "left")
        .join(parents, "pid", "left")
        .join(children, F.col("id") == F.col("cid"), "left")
        .withColumn("parent", F.when(F.col("depth") == 1, smallest).otherwise(F.col("parent")))
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    )
    run = F.concat_ws(":", "conv_id", F.expr(f"depth div {run_levels}"))
    component = F.when(F.col("depth") == 0, F.lit("root")).when(F.col("heavy").isNull(), F.hex("first")).otherwise(run)
    above = F.concat_ws(":", "parent", F.expr(f"(depth - 1) div {run_levels}"))
    of_parent = F.when(F.col("depth") == 0, F.lit(None)).when(F.col("depth") == 1, F.lit("root")).when(F.col("heavy").isNull(), component).otherwise(above)
    whole = joined.select(
        "id",
        "pid",
        "depth",
        F.coalesce(component != of_parent, F.lit(True)).alias("top"),
        (F.col("n_children") == 0).cast("bigint").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        component.alias("component"),
        of_parent.alias("above"),
        F.col("heavy").isNotNull().alias("runs"),
        "conv_id",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
    )
    whole = stage(whole, "components")
    passed = stage(pass_up(whole, held), "passed")
    tops = passed.where(F.col("top") & (F.col("depth") > 0)).select("component", "above", "pid", "leaves", "saved", "runs")
    totals = across(tops)
    messages = totals.groupBy("pid").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")).withColumnRenamed("pid", "to")
    # Components below which others hang: the root and runs along paths.
    upper = F.col("runs") | (F.col("depth") == 0)
    told = whole.where(upper).join(messages, F.col("id") == F.col("to"), "left").withColumns(
        {
            "leaves": F.col("leaves") + F.coalesce("more_leaves", F.lit(0)),
            "saved": F.col("saved") + F.coalesce("more_saved", F.lit(0)),
        }
    )
    totals = passed.where(~upper).unionByName(pass_up(told.select(*whole.columns), held))
    ends = digests_of_ends(rows.where(F.col("depth") == F.col("length")).select("id", "conv_id")).withColumnRenamed("id", "eid")
    empty = hashlib.sha256(b"").hexdigest()
    return totals.join(ends, F.col("id") == F.col("eid"), "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )


SQL = f"""
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), sha256(coalesce(text, ''))) as pos
  from conversations where conv_id is not null
), digits as (
  select conv_id, list_transform(string_split(cast(conv_id as varchar), ''), lambda c: cast(ascii(c) as bigint)) as codes
  from (select distinct conv_id from turns)
), convs as (
  select conv_id, conv_id - conv_id % {BASE_STEP} as base, xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint), codes),
    lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % {MOST_LENT} as lent
  from digits
), rebuilt as (
  select c.conv_id, 0 as own, pos, role, text from convs c join turns t on t.conv_id = base and pos <= lent
  union all select c.conv_id, 1, pos, role, text from convs c join turns t on t.conv_id = c.conv_id and pos > lent
), spoken as (
  select conv_id, list(concat(length(role), ':', role, length(text), ':', text) order by own, pos) as said,
    list(cast(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) as bigint) order by own, pos) as words
  from rebuilt group by conv_id
), members as (
  select conv_id, unnest(range(0, coalesce(len(said), 0) + 1)) as depth, coalesce(len(said), 0) as length, said, words
  from convs left join spoken using (conv_id)
), named as (
  select conv_id, depth, depth = length as ends, coalesce(words[depth], 0) as words, said,
    coalesce(array_to_string(said[1:depth], ''), '') as path, case when depth > 0 then coalesce(array_to_string(said[1:depth - 1], ''), '') end as parent
  from members
), nodes as (
  select depth, path, any_value(parent) as parent, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(words) as saved,
    any_value(said) as said, coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where ends), '') as ends
  from named group by depth, path
), children as (
  select depth - 1 as depth, parent as path, count(*) as n_children from nodes where depth > 0 group by all
), own as (
  select n.*, coalesce(n_children, 0) as n_children from nodes n left join children c on n.depth = c.depth and n.path = c.path
), climbed as (
  select unnest(range(0, depth + 1)) as depth, said, saved, case when n_children = 0 then 1 else 0 end as leaf from own
), totals as (
  select depth, coalesce(array_to_string(said[1:depth], ''), '') as path, cast(sum(saved) as bigint) as saved_tokens, cast(sum(leaf) as bigint) as n_leaves
  from climbed group by 1, 2
)
select o.conv_id, o.depth, p.conv_id as parent_conv_id, o.n_convs, o.n_children, n_leaves, saved_tokens, sha256(o.ends) as ends_sha256
from own o join totals t on o.depth = t.depth and o.path = t.path left join own p on p.depth = o.depth - 1 and p.path = o.parent
"""
