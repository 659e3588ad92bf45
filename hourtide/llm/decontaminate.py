"""Benchmark decontamination by a prefix-filtered join, with DataFrame functions only.

The sets are the windows of the benchmark items: 13 consecutive words, or the whole of a shorter item. The
tokens of a window are ordered by how often they occur in the documents, rarest first. A document can only
contain a window if it contains all its tokens, so a prefix of one token is enough to find candidates: the
document's words are joined with the rarest token of each window. A candidate fixes where the window would
begin, so what follows are bounds that cost little - it must fit into the document, and the second rarest
token must stand at its place - before the words of the window are compared as a whole.

Join and comparison happen while a document's words are in memory: neither words nor texts are shuffled,
only the verified hits. The windows are broadcast in blocks of a bounded number of bytes, however many
they are; a benchmark beyond one block costs one more scan per block.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourtide.llm.common import LOWER, UPPER, renamed, stage

WINDOW = 13
#: A document is contaminated if at least one word in so many is hit.
ONE_IN = 20
BLOCK_BYTES = 16 << 20
#: Everything in ASCII but digits and letters stands between words.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BETWEEN), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, window, words) per window of ``items`` (item_id, text); ``window`` joins its words."""
    cut = items.select("item_id", words_of(lower_ascii(F.col("text"))).alias("all"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - window + 1, F.lit(1)))
    each = cut.where(F.size("all") > 0).select("item_id", "all", F.explode(starts).alias("start"))
    words = F.slice("all", F.col("start"), F.lit(window))
    return each.select("item_id", words.alias("words")).select("item_id", F.array_join("words", " ").alias("window"), "words").distinct()


def _blocks(df: DataFrame, column: str, block_bytes: int) -> list[DataFrame]:
    """``df`` in parts of about ``block_bytes`` of ``column`` or less, to be broadcast one by one."""
    size = df.agg(F.sum(F.octet_length(column) + 64)).first()[0] or 0
    n = max(1, math.ceil(2 * size / block_bytes))
    return [df] if n == 1 else [df.where(F.pmod(F.xxhash64(column), F.lit(n)) == i) for i in range(n)]


def _key(word: Column) -> Column:
    """What words are joined by: words that are equal after lower-casing A-Z have equal keys."""
    return F.lower(word)


def token_counts(docs: DataFrame, tokens: DataFrame, block_bytes: int) -> DataFrame:
    """(token, n): how often each of ``tokens`` occurs in ``docs`` (text), over all documents."""
    each = docs.select(F.explode(words_of(F.col("text"))).alias("word")).select(_key(F.col("word")).alias("token"))
    parts = [each.join(F.broadcast(block), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n")) for block in _blocks(tokens, "token", block_bytes)]
    return reduce(DataFrame.unionByName, parts)


def anchored(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(window, length, token, at, second, second_at): the rarest and second rarest token of each window
    and their places from 0. Ties go to the earlier place; tokens that never occur are the rarest."""
    placed = windows.select("window", F.posexplode("words").alias("at", "word")).select("window", "at", _key(F.col("word")).alias("token"))
    ranked = placed.join(counts, "token", "left").select(
        "window", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "token").alias("place")
    )
    # A window has at most so many words as the parameter says.
    by_window = ranked.groupBy("window").agg(F.array_sort(F.collect_list("place")).alias("places"))
    first, second = F.get("places", F.lit(0)), F.get("places", F.least(F.lit(1), F.size("places") - 1))
    return by_window.select(
        "window", F.size("places").alias("length"), first["token"].alias("token"), first["at"].alias("at"),
        second["token"].alias("second"), second["at"].alias("second_at"),
    )


def _found(docs: DataFrame, anchors: DataFrame, listing: bool) -> DataFrame:
    """(doc_id, mark, n_words, start, length, window) per verified hit; with ``listing`` one more row per
    document, without a window. The first element of ``words`` is empty and matches no token: it stands
    for the document, and the others are numbered from 1."""
    words = F.concat(F.array(F.lit("")), words_of(F.col("text")))
    marked = docs.select("doc_id", F.xxhash64("text").alias("mark"), words.alias("words"))
    each = marked.select("doc_id", "mark", "words", F.posexplode("words").alias("place", "word"))
    each = each.withColumn("token", _key(F.col("word")))
    joined = each.join(F.broadcast(anchors), "token", "left" if listing else "inner")
    start = F.col("place") - F.col("at")
    fits = (start >= 1) & (start + F.col("length") <= F.size("words"))
    near = _key(F.get("words", start + F.col("second_at"))) == F.col("second")
    same = F.when(fits & near, lower_ascii(F.array_join(F.slice("words", start + 1, F.col("length")), " ")) == F.col("window"))
    hit = F.coalesce(same, F.lit(False))
    return joined.where(hit | (F.col("place") == 0) if listing else hit).select(
        "doc_id", "mark", (F.size("words") - 1).cast("bigint").alias("n_words"),
        F.when(F.col("place") > 0, start).alias("start"), "length", "window",
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    one_in: int = ONE_IN,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, mark.

    A word of a document is hit if it lies in any occurrence of any window; ``items_sha256`` is over the
    ids of the items with occurring windows, sorted as strings and comma-joined. Null texts, in either
    table, have no words; items without words have no window; an item without an id counts with an empty
    one. Documents without words are not contaminated. Rows that repeat an id and its text are judged
    alike, and each has its row; items that repeat a text all count. Without items nothing is hit; without
    documents there are no rows. ``mark`` (xxhash64 of the text) tells rows of one id apart. Jobs run when
    this is called: token counts, windows and hits are written.
    """
    rows = renamed(docs, doc_id=id, text=text)
    items = renamed(benchmark, item_id=item, text=item_text)
    owned = stage(item_windows(items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text"), window), "windows")
    windows = owned.select("window", "words").distinct()
    tokens = windows.select(F.explode("words").alias("word")).select(_key(F.col("word")).alias("token")).distinct()
    counts = stage(token_counts(rows, stage(tokens, "tokens"), block_bytes), "token-counts")
    anchors = stage(anchored(windows, counts), "anchors")
    found = [_found(rows, block, i == 0) for i, block in enumerate(_blocks(anchors, "window", block_bytes))]
    kept = stage(reduce(DataFrame.unionByName, found), "hits")

    hits = kept.where(F.col("start").isNotNull())
    spans = hits.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("start", "length")).alias("spans"))
    # Bounded by the words of the document, and by the items it contains.
    covered = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1))))
    n_hit = spans.select("doc_id", "mark", F.size(covered).cast("bigint").alias("n_hit"))
    named = (
        hits.select("doc_id", "mark", "window").distinct()
        .join(owned.select("window", "item_id"), "window")
        .groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    both = n_hit.join(_keyed(named), _same(n_hit)).select("doc_id", "mark", "n_hit", "items")
    listed = kept.where(F.col("start").isNull()).select("doc_id", "mark", "n_words")
    joined = listed.join(_keyed(both), _same(listed), "left")
    hit, items = F.coalesce("n_hit", F.lit(0)).cast("bigint"), F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        ((hit > 0) & (one_in * hit >= F.col("n_words"))).alias("contaminated"), "mark",
    )


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("doc_id", "doc_id_").withColumnRenamed("mark", "mark_")


def _same(left: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(F.col("doc_id_")) & (left["mark"] == F.col("mark_"))


def clean(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns."""
    judged = contamination(docs, benchmark, id, text, **how).where("contaminated").select("doc_id", "mark").distinct()
    bad = _keyed(judged)
    return docs.join(bad, docs[f"`{id}`"].eqNullSafe(bad["doc_id_"]) & (F.xxhash64(docs[f"`{text}`"]) == bad["mark_"]), "left_anti")


SQL = f"""
with items as (
  select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{BETWEEN}'), lambda w: w <> '') as words
  from benchmark
), windows as (
  select distinct item_id, array_to_string(words[p:p + {WINDOW - 1}], ' ') as w, least(len(words), {WINDOW}) as n from (
    select item_id, words, unnest(range(1, greatest(len(words) - {WINDOW - 1}, 1) + 1)) as p from items where len(words) > 0)
), docs as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{BETWEEN}'), lambda w: w <> '') as words
  from documents
), places as (
  select doc_id, words, n, unnest(range(1, len(words) - n + 2)) as p from docs, (select distinct n from windows) where len(words) >= n
), spelled as (select doc_id, p, n, array_to_string(words[p:p + n - 1], ' ') as w from places
), hits as (select s.doc_id, s.p, s.n, item_id from spelled s join windows on s.w = windows.w and s.n = windows.n
), covered as (
  select doc_id, count(distinct q) as n_hit from (select doc_id, unnest(range(p, p + n)) as q from (select distinct doc_id, p, n from hits))
  group by doc_id
), named as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct doc_id, cast(item_id as varchar) as item_id from hits) group by doc_id
)
select d.doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and {ONE_IN} * coalesce(n_hit, 0) >= len(words) as contaminated
from docs d left join covered c on d.doc_id = c.doc_id left join named i on d.doc_id = i.doc_id
"""
