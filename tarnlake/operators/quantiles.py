"""Exact quantiles by radix selection, without bringing a group into one task.

``percentile`` keeps every distinct value of a group in one buffer.  Here each double is mapped to
its ordered 64-bit image, and rows are counted per leading bits of that image, with partial counts in
the map tasks. The cells that hold a wanted rank are kept, and only their rows are counted by
the next bits, until the image is whole. All groups and probabilities go through the same passes; nothing is sorted but the cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Low bits left out of the prefix at each pass: 22, 21 and 21 bits are told apart.
LEFT_OUT = (42, 21, 0)
_UNIT = float(1 << 52)


def with_image(df: DataFrame, value: str, name: str) -> DataFrame:
    """``df`` with a long in the order of the double column: its sign, exponent and mantissa bits; both zeros, and null, give 0.

    Steps are columns of their own, so that Spark evaluates each once.
    """
    size, e, ratio = F.col("__size"), F.col("__e"), F.col("__ratio")
    rows = df.withColumn("__size", F.abs(F.col(value)))
    rows = rows.withColumn("__e", F.greatest(F.least(F.floor(F.log2(size)), F.lit(1023)), F.lit(-1022)))
    rows = rows.withColumn("__ratio", size / F.pow(F.lit(2.0), e))
    # the logarithm may be off by one at powers of two; below 2^-1022 there is no leading one
    off = F.when(ratio >= 2, 1).when((ratio < 1) & (e > -1022), -1).otherwise(0)
    scaled = F.when(ratio >= 2, ratio / 2).when((ratio < 1) & (e > -1022), ratio * 2).otherwise(ratio)
    bits = (e + 1022 + off) * F.lit(1 << 52) + (scaled * _UNIT).cast("long")
    rows = rows.withColumn("__bits", F.when(size == 0, F.lit(0)).when(size == float("inf"), F.lit(2047 << 52)).otherwise(bits))
    # never null, or a join on it would make Spark infer a filter that evaluates all of this again
    signed = F.when(F.col(value) < 0, -F.col("__bits")).otherwise(F.col("__bits"))
    return rows.withColumn(name, F.coalesce(signed, F.lit(0))).drop("__size", "__e", "__ratio", "__bits")


def _prefix(left_out: int) -> Column:
    return F.shiftright("__i", left_out)


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), few_groups: bool = False) -> DataFrame:
    """Linear-interpolated quantiles of ``value``, overall or per ``by``.

    Returns the ``by`` columns, ``n`` and an array ``q`` in the order of ``probs``. Null and NaN are left out; a null
    in ``by`` is a group of its own. With ``few_groups``, for a number of groups that the caller knows to be small, the
    cells (two for each group and probability) are broadcast; otherwise Spark decides by their size.
    """
    by, probs = list(by), list(probs)
    v = F.col(value).cast("double")
    group = F.struct(*by) if by else F.lit(0)  # a struct: its nulls are equal to each other
    rows = with_image(df.where(v.isNotNull() & ~F.isnan(v)).select(group.alias("__g"), v.alias("__v")), "__v", "__i")
    small = F.broadcast if few_groups or not by else (lambda x: x)
    places = [f"r{i}" for i in range(2 * len(probs))]

    counts = rows.groupBy("__g", _prefix(LEFT_OUT[0]).alias("p")).agg(F.count(F.lit(1)).alias("c"))
    counts = counts.withColumn("n", F.sum("c").over(Window.partitionBy("__g")))
    at = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    counts = counts.withColumns({r: (F.ceil if i % 2 else F.floor)(at[i // 2]) for i, r in enumerate(places)})
    cells = _holding(counts, ["__g"], places)
    for last, left_out in zip(LEFT_OUT, LEFT_OUT[1:]):
        cells = cells.select("__g", F.col("p").alias("q"), "n", *places)
        kept = rows.withColumn("q", _prefix(last)).join(small(cells), ["__g", "q"])
        kept = kept.groupBy("__g", "q", _prefix(left_out).alias("p")).agg(
            F.count(F.lit(1)).alias("c"), F.max("__v").alias("v"), *[F.max(x).alias(x) for x in ("n", *places)])
        cells = _holding(kept, ["__g", "q"], places)
    found = cells.groupBy("__g").agg(F.max("n").alias("n"), *[F.max(F.when(F.col(r).isNotNull(), F.col("v"))).alias(r) for r in places])
    out = []
    for i, a in enumerate(at):
        low, high = F.col(places[2 * i]), F.col(places[2 * i + 1])
        out.append(F.when(low == high, low).otherwise(low + (a - F.floor(a)) * (high - low)))
    return found.select(*[F.col("__g")[c].alias(c) for c in by], "n", F.array(*out).alias("q"))


def _holding(counts: DataFrame, within: Sequence[str], places: Sequence[str]) -> DataFrame:
    """The cells that hold a wanted place; places are counted from the cell's first row on, null where they lie elsewhere.

    The window runs over the cells of a group, 2^22 at most, not over rows.
    """
    so_far = Window.partitionBy(*within).orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    upto, before = F.col("__upto"), F.col("__upto") - F.col("c")
    moved = {r: F.when((F.col(r) >= before) & (F.col(r) < upto), F.col(r) - before) for r in places}
    return counts.withColumn("__upto", F.sum("c").over(so_far)).withColumns(moved).where(F.coalesce(*places).isNotNull()).drop("__upto", "c")
