"""Exact quantiles of columns of any size, for any number of groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegrid.sources.stage import stage

# A sketch with this accuracy is off by at most one ten-thousandth of a group's rows.
ACCURACY = 10_000
# The enclosing values are asked for this many such errors away from the wanted rank.
SLACK = 4.0
# Into how many parts a round of :func:`_by_counted_ranks` cuts what is left.
PARTS = 64


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = ACCURACY,
    slack: float = SLACK,
) -> DataFrame:
    """Quantiles with linear interpolation as rows ``(by, column, prob, value)``.

    Three scans at any size: sketches give two values that enclose each wanted rank, then
    the rows below the first are counted, and the values between them one by one, which are a
    few ten-thousandths of the rows. All of it combines map-side and no value is shuffled
    whole. Where a sketch did not enclose its rank, that rank alone is looked for again between values
    whose ranks are counted. Missing and NaN cells are left out; infinite ones count as the largest.
    Groups without a value give no row. Stage ``df`` first if it is costly to compute.
    """
    group = [f"__g{i}" for i in range(len(by))] + ["__all"]
    cells = df.select(
        *[F.col(c).alias(g) for c, g in zip(by, group)], F.lit(0).alias("__all"),
        *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"__c{i}") for i, c in enumerate(cols)],
    )
    slack = slack / accuracy
    targets = [(i, j) for i in range(len(cols)) for j in range(len(probs))]
    ends = [F.lit(min(1.0, max(0.0, p + d))) for p in probs for d in (-slack, slack)]
    bounds = []
    for i in range(len(cols)):
        c = F.col(f"__c{i}")
        bounds += [F.count(c).alias(f"__n{i}"),
                   F.percentile_approx(c, F.array(*ends), F.lit(accuracy)).alias(f"__q{i}")]
    bounds = cells.groupBy(*group).agg(*bounds)
    if by:
        joined = _with_bounds(cells, stage(bounds, "quantile_bounds"), group)
    else:  # one row of bounds becomes literals
        row = (bounds.take(1) or [None])[0]
        joined = cells.withColumns({
            name: F.lit(row[name] if row else None).cast(bounds.schema[name].dataType)
            for i in range(len(cols)) for name in (f"__n{i}", f"__q{i}")})

    def low(i: int, j: int) -> Column:
        return F.col(f"__q{i}")[2 * j]

    def high(i: int, j: int) -> Column:
        return F.col(f"__q{i}")[2 * j + 1]

    below = joined.groupBy(*group).agg(*[
        F.struct(F.count_if(F.col(f"__c{i}") < low(i, j)).alias("below"),
                 F.max(F.when(F.col(f"__c{i}") < low(i, j), F.col(f"__c{i}"))).alias("previous"),
                 F.min(F.when(F.col(f"__c{i}") > high(i, j), F.col(f"__c{i}"))).alias("next")).alias(f"__b{i}_{j}")
        for i, j in targets])
    below = below.select(*group, F.inline(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"__b{i}_{j}").alias("around")) for i, j in targets])))
    between = joined.select(*group, F.inline(F.array_compact(F.array(*[
        F.when(F.col(f"__c{i}").between(low(i, j), high(i, j)), F.struct(
            F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"__c{i}").alias("value"), F.col(f"__n{i}").alias("total")))
        for i, j in targets])))).groupBy(*group, "i", "j", "value").agg(
        F.count(F.lit(1)).alias("n"), F.any_value("total").alias("total"))
    key = [*group, "i", "j"]
    values = between.join(
        below.select(*[F.col(k).alias(f"{k}_") for k in key], "around.*"),
        _equal(key), "left").drop(*[f"{k}_" for k in key])
    upto = F.sum("n").over(Window.partitionBy(*key).orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    values = values.withColumn("upto", F.col("below") + upto).withColumn(
        "rank", F.array(*[F.lit(float(p)) for p in probs])[F.col("j")] * (F.col("total") - 1))
    first, second = F.floor("rank"), F.ceil("rank")

    def at(rank: Column) -> Column:
        inside = F.max(F.when((F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto")), F.col("value")))
        # the second rank may be the first one behind the enclosed values, and the first the last before them
        return F.coalesce(inside, F.max(F.when(rank == F.col("below") - 1, F.col("previous"))),
                          F.when(F.max(rank) == F.max("upto"), F.min("next")))

    found = stage(values.groupBy(*key).agg(at(first).alias("a"), at(second).alias("b"), F.any_value("rank").alias("rank")),
                  "quantiles")
    missed = found.where("a IS NULL OR b IS NULL")
    if not missed.isEmpty():
        found = found.where("a IS NOT NULL AND b IS NOT NULL").unionByName(_found_again(cells, missed, group))
    part = F.col("rank") - F.floor("rank")
    value = F.when((part == 0) | (F.col("a") == F.col("b")), F.col("a")).otherwise(
        F.col("a") * (1 - part) + F.col("b") * part)
    return found.select(
        *[F.col(g).alias(c) for c, g in zip(by, group)], F.array(*[F.lit(c) for c in cols])[F.col("i")].alias("column"),
        F.array(*[F.lit(float(p)) for p in probs])[F.col("j")].alias("prob"), value.alias("value"))


def _found_again(cells: DataFrame, missed: DataFrame, group: Sequence[str]) -> DataFrame:
    """The rows of ``missed`` with the values ``a`` and ``b`` at the two ranks around ``rank``."""
    key = [*group, "i", "j"]
    wanted = missed.select(*key, "rank", F.explode(F.array_distinct(F.array(F.floor("rank"), F.ceil("rank")))).alias("at"))
    columns = sorted(r["i"] for r in missed.select("i").distinct().collect())
    long = cells.select(*group, F.inline(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(f"__c{i}").alias("v")) for i in columns]))).where("v IS NOT NULL")
    exact = _by_counted_ranks(long, wanted, group)
    return exact.groupBy(*key).agg(
        F.max(F.when(F.col("at") == F.floor("rank"), F.col("lo"))).alias("a"),
        F.max(F.when(F.col("at") == F.ceil("rank"), F.col("lo"))).alias("b"), F.any_value("rank").alias("rank"))


def _by_counted_ranks(long: DataFrame, wanted: DataFrame, group: Sequence[str]) -> DataFrame:
    """``wanted`` with the value ``lo`` that stands ``at`` this place (from 0) among its group's values ``v``.

    Each round takes values from the range that is left, whatever their ranks are, counts what lies on each of
    them and between them, and keeps the part with the wanted place. A value and what lies beside it are never in one
    part, so the range shrinks in every round, about ``PARTS`` times when the sketch is good, until one value is left.
    """
    key = [*group, "i", "j", "rank", "at"]
    left = wanted.withColumns({"lo": F.lit(float("-inf")), "hi": F.lit(float("inf")), "base": F.lit(0).cast("long")})

    def inside(ranges: DataFrame) -> DataFrame:
        ranges = ranges.select(*[F.col(k).alias(f"{k}_") if k in (*group, "i") else F.col(k) for k in ranges.columns])
        on = _equal([*group, "i"]) & F.col("v").between(F.col("lo"), F.col("hi"))
        return long.join(ranges, on).drop(*[f"{k}_" for k in (*group, "i")])

    done = None
    while True:
        cuts = F.array(*[F.lit(n / PARTS) for n in range(PARTS + 1)])
        cut = stage(inside(left).groupBy(*key, "lo", "hi", "base").agg(
            F.array_distinct(F.percentile_approx("v", cuts, F.lit(10 * PARTS))).alias("cuts")), "quantile_cuts")
        # an even number for what lies between two cuts, an odd one for a cut itself
        part = F.size(F.filter("cuts", lambda c: c < F.col("v"))) + F.size(F.filter("cuts", lambda c: c <= F.col("v")))
        parts = inside(cut).groupBy(*key, "base", part.alias("part")).agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        before = F.coalesce(F.sum("n").over(Window.partitionBy(*key).orderBy("part").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
        parts = parts.withColumn("base", F.col("base") + before)
        left = stage(parts.where("base <= at AND at < base + n").select(*key, "lo", "hi", "base"), "quantile_ranges")
        one = left.where("lo = hi")
        done = one if done is None else done.unionByName(one)
        left = left.where("lo <> hi")
        if left.isEmpty():
            return done


def _with_bounds(cells: DataFrame, bounds: DataFrame, group: Sequence[str]) -> DataFrame:
    renamed = bounds.select(*[F.col(g).alias(f"{g}_") for g in group], *[c for c in bounds.columns if c not in group])
    on = F.col(group[0]).eqNullSafe(F.col(f"{group[0]}_"))
    for g in group[1:]:
        on = on & F.col(g).eqNullSafe(F.col(f"{g}_"))
    return cells.join(renamed, on)


def _equal(key: Sequence[str]) -> Column:
    on = F.lit(True)
    for k in key:
        on = on & F.col(k).eqNullSafe(F.col(f"{k}_"))
    return on
