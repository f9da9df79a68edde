"""Exact quantiles (linear interpolation) of groups of any size, by distributed radix selection.

No values are sorted and no group meets in one task. Every pass counts the rows that can still
hold a wanted rank in the cells of a histogram; counts combine map-side, so only cells are
shuffled. The first pass takes 64ths of a binary order of magnitude (sign and ``log2``) and
also gives count, mean, deviation, minimum and maximum. Every further pass divides the range
between a cell's least and greatest value into 16384 equal parts. A rank is found as soon as it is
the first or last of its cell or the cell holds one value. A range of doubles shrinks by
14 bits a pass, so four passes after the first end every search; half a million spread values take two passes in all.

Rounding can't disorder cells: ``log2``, differences, quotients and ``floor`` never decrease
when the value grows, and the histogram needs no more than that.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelhouse.plans.scratch import materialize

PARTS = 1 << 14
_STEPS = 64


def _magnitude(v: Column) -> Column:
    """The cell of a value in the first pass. Zero, the infinities and NaN have their own."""
    size = F.floor(F.log2(F.abs(v)) * _STEPS).cast("int") + 100_000
    infinite = F.abs(v) == float("inf")
    return (
        F.when(F.isnan(v), F.lit(1_000_000))
        .when(infinite, F.signum(v).cast("int") * 999_999)
        .when(v == 0, F.lit(0))
        .otherwise(F.when(v < 0, -size).otherwise(size))
    )


def _part(v: Column, low: Column, high: Column) -> Column:
    return F.floor((v - low) / (high - low) * PARTS).cast("int")


def _cells(rows: DataFrame, keys, cell: Column, *more) -> DataFrame:
    v = F.col("_v")
    return rows.groupBy(*keys, cell.alias("_cell")).agg(
        F.count("*").alias("_c"), F.min(v).alias("_least"), F.max(v).alias("_most"), *more
    )


def _ranks(probs):
    """The two neighbouring ranks of each quantile, as SQL over ``n``."""
    sides = []
    for p in probs:
        sides += [f"floor((n - 1) * {p!r}D)", f"ceil((n - 1) * {p!r}D)"]
    pairs = ", ".join(
        f"struct({i} AS slot, bigint({side}) AS rank)" for i, side in enumerate(sides)
    )
    return F.expr(f"array({pairs})")


def _placed(cells: DataFrame, keys) -> DataFrame:
    """Cells with the number of rows in the cells below: a window over one histogram."""
    below = Window.partitionBy(*keys).orderBy("_cell")
    upto = F.sum("_c").over(below.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return cells.withColumn("_below", upto - F.col("_c"))


def _searched(by) -> list:
    rank, one = F.col("rank") - F.col("_below"), F.col("_least") == F.col("_most")
    value = (
        F.when((rank == 0) | one, F.col("_least"))
        .when(rank == F.col("_c") - 1, F.col("_most"))
    )
    return [*by, "slot", rank.alias("rank"), "_least", "_most", value.alias("value")]


def exact_quantiles(df: DataFrame, by, value: str, probs) -> DataFrame:
    """``(by, n, mean, std, min, max, quantiles)`` of the non-null values of each group.

    Rows with a null key are left out, as in every grouping here.
    """
    by, probs = list(by), [float(p) for p in probs]
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).dropna(subset=by)
    rows = rows.where(F.col("_v").isNotNull())
    cells = materialize(
        _cells(
            rows, by, _magnitude(F.col("_v")),
            F.avg("_v").alias("_mean"), F.var_pop("_v").alias("_var"),
        ),
        "quantile-cells",
    )
    facts = _moments(cells, by)
    first = _placed(cells, by).join(facts.select(*by, "n"), by)
    wanted = F.filter(
        _ranks(probs),
        lambda r: (r["rank"] >= F.col("_below")) & (r["rank"] < F.col("_below") + F.col("_c")),
    )
    state = first.select("*", F.inline(wanted)).select(*_searched(by))
    found = []
    while True:
        state = materialize(state, "quantile-ranks")
        found.append(state.where("value IS NOT NULL").select(*by, "slot", "value"))
        open_ = state.where("value IS NULL").drop("value")
        if open_.isEmpty():
            break
        # Few ranges (at most two a quantile and group), so that as a rule rows stay where they are.
        range_ = [*by, "_low", "_high"]
        open_ = open_.withColumnsRenamed({"_least": "_low", "_most": "_high"})
        inside = rows.join(open_.select(*range_).distinct(), by).where("_v BETWEEN _low AND _high")
        parts = _cells(inside, range_, _part(F.col("_v"), F.col("_low"), F.col("_high")))
        hit = (F.col("rank") >= F.col("_below")) & (F.col("rank") < F.col("_below") + F.col("_c"))
        state = _placed(parts, range_).join(open_, range_).where(hit).select(*_searched(by))
    values = found[0]
    for more in found[1:]:
        values = values.unionByName(more)
    slots = values.groupBy(*by).agg(
        *[F.max(F.when(F.col("slot") == i, F.col("value"))).alias(f"_s{i}") for i in range(2 * len(probs))]
    )
    return facts.join(slots, by).select(
        *by, "n", "mean", "std", "min", "max",
        F.array(*[_between(i, p) for i, p in enumerate(probs)]).alias("quantiles"),
    )


def _between(i: int, p: float) -> Column:
    a, b, at = F.col(f"_s{2 * i}"), F.col(f"_s{2 * i + 1}"), (F.col("n") - 1) * F.lit(p)
    return a + (at - F.floor(at)) * (b - a)


def _moments(cells: DataFrame, by) -> DataFrame:
    """Count, mean, sample deviation and extremes of each group from those of its cells."""
    totals = cells.groupBy(*by).agg(
        F.sum("_c").alias("n"), (F.sum(F.col("_c") * F.col("_mean")) / F.sum("_c")).alias("mean"),
        F.min("_least").alias("min"), F.max("_most").alias("max"),
        F.collect_list(F.struct("_c", "_mean", "_var")).alias("_held"),
    )
    squares = F.aggregate(
        "_held", F.lit(0.0),
        lambda a, h: a + h["_c"] * (h["_var"] + (h["_mean"] - F.col("mean")) * (h["_mean"] - F.col("mean"))),
    )
    std = F.when(F.col("n") > 1, F.sqrt(squares / (F.col("n") - 1)))
    return totals.select(*by, "n", "mean", std.alias("std"), "min", "max")
