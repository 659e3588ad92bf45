"""Mixing sources to target weights, with DataFrame functions only.

Words are summed per source before anything is shuffled by source. The targets come from two running
totals over the sources (one row each), so their number is not bounded either. Documents then get their
source's repetition rate: floor(rate) copies plus one more if the document's own seeded hash falls below
a bound. The bound is the fraction of the rate, moved to where the words of the hashes below it come
nearest to the words still wanted: hashes are even, so it stays close to the fraction, but a few very
long documents cannot carry a source off its target. It comes from a running total by hash, which no
source gathers in one task. Given the table of bounds, no row is needed to decide about another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourtide.llm.common import free_name, stage
from hourtide.operators.ranks import running_totals

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def draw(id: Column, text: Column, seed: str = SEED) -> Column:
    """An even number of 52 bits from the md5 of seed and id, or of seed and text where there is no id. Rows with one id
    share it, and so do rows without one that have the same text."""
    own = F.coalesce(id.cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(text, F.lit("")))))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), own)), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, weight, target, rate) per source of ``sizes`` (source, size).

    Sources by code point, the missing one last, weigh ``weights``, repeating, and share the sum of all
    sizes. A target stops at ``most`` times its source's size, and the excess goes to the others by weight
    until none is above. That is one water level: with the sources ordered by the level at which each
    stops, the level is the first, and so the highest, that leaves the next source below its stop. A source without words has
    target 0 and rate 1.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = per_source.select(
        "*", F.lit(1).cast("bigint").alias("one"), F.struct(F.col("source").isNull().alias("missing"), "source").alias("name")
    )
    weight = F.get(F.array(*[F.lit(w).cast("bigint") for w in weights]), F.pmod(F.col("one_before"), F.lit(len(weights))).cast("int"))
    stop = F.lit(most) * F.col("source_size")
    weighed = running_totals(named, "name", ["one"]).select(
        "source", "source_size", weight.alias("weight"), stop.alias("stop"), F.struct((stop / weight).alias("level"), "name").alias("stops")
    )
    levels = running_totals(weighed, "stops", ["source_size", "stop", "weight"])
    level = (F.col("source_size_total") - F.col("stop_before")) / (F.col("weight_total") - F.col("weight_before"))
    at = levels.where(level <= F.col("stops.level")).agg(F.max(level).alias("level")).scalar()
    target = F.least(F.col("stop").cast("double"), at * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(1.0))
    return levels.select("source", "source_size", "weight", target.alias("target"), rate.alias("rate"))


def source_bounds(sizes: DataFrame, **how) -> DataFrame:
    """``source_targets`` of ``sizes`` (source, size, draw) with ``bound``: the largest hash that gets one copy
    more than floor(rate), null if none does."""
    targets = stage(source_targets(sizes, **how), "targets")
    drawn = sizes.groupBy("source", "draw").agg(F.sum("size").alias("size"))
    summed = running_totals(drawn, "draw", ["size"], ["source"]).select(F.col("source").alias("named"), "draw", "size", "size_before")
    wanted = F.col("target") - F.floor("rate") * F.col("source_size")
    # Rows without words bring a source no nearer to its target: they set no bound, and none holds for them.
    inside = F.when((F.col("size") > 0) & (F.col("size_before") + F.col("size") / 2 <= wanted), F.col("draw"))
    joined = summed.join(targets, F.col("named").eqNullSafe(F.col("source")))
    bounds = joined.groupBy("source", "source_size", "target", "rate").agg(F.max(inside).alias("bound"))
    return stage(bounds, "bounds")


def copies(rate: Column, drawn: Column, bound: Column, size: Column) -> Column:
    """floor(rate), and one more for a row with words whose hash is within the bound."""
    return F.floor(rate) + F.coalesce((drawn <= bound) & (size > 0), F.lit(False)).cast("bigint")


def mix_report(df: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """One row per row of ``df``: doc_id, size, source_size, target, taken, copies.

    A null text has size 0; null sources are one source. A row without words has floor(rate) copies, one in a source
    without any words; where the rate is a whole number all rows have that many, so no row has more than the rate's ceiling.
    Rows of one id share their hash and are decided alike, and so are rows without an id that have one text; repeated rows too.
    An empty table gives no rows. Runs jobs: sizes and targets are written first.
    """
    sized = df.select(
        df[f"`{id}`"].alias("doc_id"),
        df[f"`{source}`"].alias("source"),
        n_words(df[f"`{text}`"]).alias("size"),
        draw(df[f"`{id}`"], df[f"`{text}`"]).alias("draw"),
    )
    sized = stage(sized, "sizes")
    targets = source_bounds(sized.drop("doc_id"), **how).withColumnRenamed("source", "named")
    n = copies(F.col("rate"), F.col("draw"), F.col("bound"), F.col("size"))
    return sized.join(targets, F.col("source").eqNullSafe(F.col("named"))).select(
        "doc_id", "size", "source_size", "target", (n * F.col("size")).alias("taken"), n.alias("copies")
    )


def mix(df: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The mix itself: the rows of ``df``, each as often as ``mix_report`` has copies of it, with the same columns."""
    drawn = draw(df[f"`{id}`"], df[f"`{text}`"])
    sized = stage(df.select(df[f"`{source}`"].alias("source"), n_words(df[f"`{text}`"]).alias("size"), drawn.alias("draw")), "sizes")
    named, rate, bound, copy = (free_name(df.columns, x) for x in ("named", "rate", "bound", "copy"))
    bounds = source_bounds(sized, **how)
    targets = bounds.select(F.col("source").alias(named), F.col("rate").alias(rate), F.col("bound").alias(bound))
    taken = df.join(targets, df[f"`{source}`"].eqNullSafe(F.col(named)))
    n = copies(F.col(rate), draw(F.col(f"`{id}`"), F.col(f"`{text}`")), F.col(bound), n_words(F.col(f"`{text}`")))
    each = taken.withColumn(copy, F.explode(F.array_repeat(F.lit(True), n.cast("int"))))
    return each.select(*[F.col(f"`{c}`") for c in df.columns])


SQL = f"""
with sized as (
  select doc_id, text, source, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size from documents
), per_source as (
  select source, cast(sum(size) as bigint) as source_size from sized group by source
), ranked as (
  select *, (row_number() over (order by source is null, source) - 1) % 3 as place from per_source
), weighed as (
  select *, case place when 0 then 5 when 1 then 2 else 1 end as weight, 3 * source_size as stop from ranked
), levels as (
  select *, stop / weight as stop_level,
    coalesce(sum(stop) over before, 0) as stop_before, coalesce(sum(weight) over before, 0) as weight_before,
    sum(source_size) over () as total, sum(weight) over () as weight_total
  from weighed
  window before as (order by stop / weight, source is null, source rows between unbounded preceding and 1 preceding)
), water as (
  select max((total - stop_before) / (weight_total - weight_before)) as level from levels
  where (total - stop_before) / (weight_total - weight_before) <= stop_level
), targets as (
  select source, source_size, least(cast(stop as double), level * weight) as target from levels, water
), rated as (
  select *, case when source_size > 0 then target / source_size else 1.0 end as rate from targets
), draws as (
  select doc_id, size, source, cast(('0x' || md5('{SEED}:' || coalesce(cast(doc_id as varchar), 'null:' || md5(coalesce(text, ''))))[1:13]) as bigint) as draw from sized
), summed as (
  select source, draw, size, coalesce(sum(size) over (partition by source order by draw rows between unbounded preceding and 1 preceding), 0) as before
  from (select source, draw, sum(size) as size from draws group by source, draw)
), bounds as (
  select r.source, source_size, target, rate, max(draw) filter (size > 0 and before + size / 2 <= target - floor(rate) * source_size) as bound
  from rated r join summed s on r.source is not distinct from s.source group by r.source, source_size, target, rate
)
select doc_id, size, source_size, target, copies * size as taken, copies from (
  select *, cast(floor(rate) as bigint) + case when coalesce(draw <= bound and size > 0, false) then 1 else 0 end as copies
  from draws d join bounds b on d.source is not distinct from b.source)
"""
