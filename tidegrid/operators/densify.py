"""A regular grid: one row per series and step, missing measures NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidegrid.functions.calendar import epoch_seconds, from_epoch_seconds
from tidegrid.operators.blocks import BLOCK, BLOCK_ROWS
from tidegrid.operators.shares import bounded_shares, parts_for


def step_index(t, step_seconds: int):
    return F.floor(epoch_seconds(t) / step_seconds)


def series_spans(
    df: DataFrame, keys: Sequence[str], t: str, step_seconds: int, span: str = "series"
) -> DataFrame:
    """First and last step index per series; ``common`` gives every series the overall span."""
    i = step_index(t, step_seconds)
    if span == "series":
        return df.groupBy(*keys).agg(F.min(i).alias("lo"), F.max(i).alias("hi"))
    if span != "common":
        raise ValueError(f"unknown span {span!r}")
    overall = df.agg(F.struct(F.min(i).alias("lo"), F.max(i).alias("hi")).alias("s")).scalar()
    return (
        df.select(*keys)
        .distinct()
        .withColumn("__s", overall)
        .select(*keys, F.col("__s.lo").alias("lo"), F.col("__s.hi").alias("hi"))
    )


def densify(
    df: DataFrame,
    keys: Sequence[str],
    t: str = "t",
    step_seconds: int = 3600,
    span: str = "series",
    spans: DataFrame | None = None,
    pos: str = "pos",
    size: int = BLOCK_ROWS,
) -> DataFrame:
    """The full grid with the cells of ``df``; adds ``pos``, the step number in the series.

    ``df`` holds at most one row per series and step; a second one fails the job. A row between
    two steps belongs to the earlier one, and ``t`` is that step's time. By default a
    series' grid ends with its own first and last step; ``span="common"`` gives every series
    the steps of all. ``spans`` (from :func:`series_spans`) may come from a cheaper table than ``df``.

    Blocks of ``size`` steps are dealt out, the grid as one row a block and cells as they are; only there do
    the steps without a cell grow, so the full panel is never shuffled or joined. The steps are summed up from ``spans``
    beforehand, since few rows grow to many, which sizes don't show: tasks and later shuffles follow that number.
    """
    if spans is None:
        spans = series_spans(df, keys, t, step_seconds, span)
    spark, home = df.sparkSession, [*keys, BLOCK]
    total = int(spans.agg(F.sum(F.col("hi") - F.col("lo") + 1)).first()[0] or 0)
    bounded_shares(df, total)
    tasks = parts_for(spark, total)
    values = [c for c in df.columns if c not in keys and c != t]
    step = step_index(t, step_seconds)
    cells = df.select(*keys, F.floor(step / size).alias(BLOCK), F.struct(step.alias("__step"), F.struct(*values, F.lit(
        True).alias("__there")).alias("__row")).alias("__cell")).repartition(tasks, *home).groupBy(*home).agg(
        F.collect_list("__cell").alias("__cells"))
    blocks = spans.select(*keys, "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") / size), F.floor(F.col("hi") / size))).alias(BLOCK)).repartition(tasks, *home)
    first = F.col(BLOCK) * size
    begin, end = F.greatest(first, "lo"), F.least(first + (size - 1), "hi")
    met = blocks.join(cells, home, "left").withColumn(
        "__cells", F.filter(F.coalesce("__cells", F.array()), lambda c: c["__step"].between(begin, end)))
    steps = F.transform("__cells", lambda c: c["__step"])
    twice = F.raise_error(F.concat(F.lit("several rows for one step of series "),
                                   F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])))
    cell = cells.schema["__cells"].dataType.elementType
    missing = F.transform(F.array_except(F.sequence(begin, end), steps), lambda i: F.struct(
        i.alias("__step"), F.lit(None).cast(cell["__row"].dataType).alias("__row")))
    once = F.when(F.size(F.array_distinct(steps)) == F.size(steps), F.concat("__cells", missing)).otherwise(twice)
    rows = met.select(*home, "lo", F.explode(once).alias("__cell"))
    return rows.select(
        *keys, from_epoch_seconds(F.col("__cell.__step") * step_seconds).alias(t), (F.col("__cell.__step") - F.col("lo")).alias(pos),
        *[F.col(f"__cell.__row.{c}").alias(c) for c in values])
