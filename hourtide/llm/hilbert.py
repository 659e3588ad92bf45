"""Sharding along a Hilbert curve, with DataFrame functions only.

Every dimension is quantised to equally filled bins through running counts over its distinct values. The
bins are a point on a grid, the point's place on the Hilbert curve orders the rows, and a running total of
their bytes cuts the order into runs of nearly equal size. Neighbours on the curve are neighbours in every
dimension, so each shard covers a small box of values and file statistics can skip it.

Running totals go by ranges (see ``hourtide.operators.ranks``): no task holds a whole dimension or shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from hourtide.llm.common import stage
from hourtide.operators.ranks import running_totals

DIMENSIONS = ("source", "lang", "size")
BITS = 10
SHARDS = 8


def curve_index(point: Column, dims: int, bits: int) -> Column:
    """The place on the Hilbert curve of a point: an array of ``dims`` numbers below 2^``bits``.

    The usual transposed form: from the highest bit down, each axis exchanges or inverts its lower bits
    with the first; a Gray code over the axes follows; the bits of all axes are then interleaved.
    """
    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(d).alias("i")) for b in range(bits - 1, 0, -1) for d in range(dims)])

    def turn(x: Column, step: Column) -> Column:
        q, i = step["q"], step["i"]
        low = q - 1
        first, own = F.get(x, F.lit(0)), F.get(x, i)
        swapped = first.bitwiseXOR(own).bitwiseAND(low)
        inverts = own.bitwiseAND(q) != 0
        return F.transform(
            x,
            lambda v, j: F.when(inverts, F.when(j == 0, v.bitwiseXOR(low)).otherwise(v)).otherwise(
                F.when((j == 0) | (j == i), F.when(i == 0, v).otherwise(v.bitwiseXOR(swapped))).otherwise(v)
            ),
        )

    turned = F.aggregate(steps, point, turn)

    def gray(x: Column) -> Column:
        # Each axis becomes the XOR of itself and all before it.
        return F.aggregate(
            x,
            F.struct(F.array().cast("array<int>").alias("done"), F.lit(0).alias("last")),
            lambda acc, v: F.struct(
                F.concat(acc["done"], F.array(acc["last"].bitwiseXOR(v))).alias("done"), acc["last"].bitwiseXOR(v).alias("last")
            ),
            lambda acc: acc["done"],
        )

    powers = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)])

    def flips(x: Column) -> Column:
        last = F.get(x, F.lit(dims - 1))
        return F.aggregate(
            powers, F.lit(0), lambda t, q: F.when(last.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t)
        )

    def index(x: Column) -> Column:
        places = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(d).alias("d")) for b in range(bits - 1, -1, -1) for d in range(dims)])
        return F.aggregate(
            places,
            F.lit(0).cast("bigint"),
            lambda t, p: t * 2 + F.when(F.get(x, p["d"]).bitwiseAND(F.call_function("shiftleft", F.lit(1), p["b"])) != 0, 1).otherwise(0),
        )

    # Each step is bound once as the single element of an array, so that no expression is repeated.
    def bound(value: Column, use) -> Column:
        return F.get(F.transform(F.array(value), use), F.lit(0))

    return bound(
        turned,
        lambda a: bound(gray(a), lambda b: bound(flips(b), lambda t: index(F.transform(b, lambda v: v.bitwiseXOR(t))))),
    )


def _ordered(df: DataFrame, name: str) -> Column:
    """A value of any dimension in one type that keeps its order: numbers by value, others as strings."""
    numeric = isinstance(df.schema[name].dataType, NumericType)
    number = F.col(name).cast("double") if numeric else F.lit(None).cast("double")
    string = F.lit(None).cast("string") if numeric else F.col(name).cast("string")
    return F.struct(number.alias("number"), string.alias("string"))


def points(df: DataFrame, dimensions: list[str], bits: int) -> DataFrame:
    """Add ``point``, the bins of all dimensions. Nulls are a value of their own, the smallest."""
    values = [_ordered(df, d) for d in dimensions]
    long = df.select(F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), v.alias("value")) for d, v in zip(dimensions, values)])).alias("x"))
    counts = long.groupBy("x.dim", "x.value").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counts, "value", ["n"], ["dim"])
    # The middle of the value's rows decides its bin.
    bin = F.floor((2 * F.col("n_before") + F.col("n")) * F.lit(1 << (bits - 1)) / F.col("n_total")).cast("int")
    bins = stage(ranked.select("dim", "value", bin.alias("bin")), "bins")
    placed = df
    for i, (d, v) in enumerate(zip(dimensions, values)):
        own = bins.where(F.col("dim") == d).select(F.col("value").alias(f"value{i}_"), F.col("bin").alias(f"bin{i}_"))
        placed = placed.join(own, v.eqNullSafe(F.col(f"value{i}_")))
    return placed.select("*", F.array(*[f"bin{i}_" for i in range(len(dimensions))]).alias("point")).drop(
        *[f"{x}{i}_" for i in range(len(dimensions)) for x in ("bin", "value")]
    )


def shard_by_curve(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    dimensions: tuple[str, ...] = DIMENSIONS,
    shards: int = SHARDS,
    bits: int = BITS,
) -> DataFrame:
    """One row per row of ``df``: doc_id, size, text_crc32, law, shard, slot, grown_shard, curve.

    ``size`` is the UTF-8 bytes of the text (null: none) plus 1; it may be named as a dimension. The law is
    ``bytes``: a row belongs to the run in which the middle of its bytes falls, so a run's size differs
    from the mean by less than one row on either side. Slots count from 0 without gaps within a shard.
    Rows of equal rank on the curve follow their ids, then their checksums; repeated rows are alike, so
    their order does not matter. An empty table gives no rows. ``dims * bits`` must stay below 63.
    Jobs run when this is called.
    """
    body = F.coalesce(F.encode(df[f"`{text}`"], "UTF-8"), F.lit(b""))
    others = [d for d in dimensions if d != "size"]
    rows = df.select(
        df[f"`{id}`"].alias("doc_id"),
        (F.octet_length(body).cast("bigint") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"),
        *[df[f"`{d}`"].alias(f"by_{d}") for d in others],
    )
    rows = stage(rows, "sizes")
    named = ["size" if d == "size" else f"by_{d}" for d in dimensions]
    place = curve_index(F.col("point"), len(named), bits)
    ordered = points(rows, named, bits).select("doc_id", "size", "text_crc32", place.alias("curve")).select(
        "*", F.lit(1).cast("bigint").alias("one"), F.struct("curve", "doc_id", "text_crc32").alias("place")
    )
    cut = running_totals(ordered, "place", ["size", "one"])
    middle = (2 * F.col("size_before") + F.col("size")) * shards
    shard = F.least(F.floor(middle / (2 * F.col("size_total"))), F.lit(shards - 1)).cast("int")
    cut = stage(cut.select("doc_id", "size", "text_crc32", "curve", shard.alias("shard"), "one_before"), "runs")
    firsts = cut.groupBy("shard").agg(F.min("one_before").alias("first"))
    # One row per shard, a parameter.
    return cut.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("one_before") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )
