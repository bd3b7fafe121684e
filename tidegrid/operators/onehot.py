"""One-hot encoding of columns with any number of values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidegrid.operators.lookup import lookup_join
from tidegrid.sources.stage import stage


def vocabulary_index(df: DataFrame, c: str) -> DataFrame:
    """The distinct values of ``c`` with their place in sorted order, from 0, as a staged table ``(c, index)``.

    Values are dealt out in ranges and numbered in each; how many stand in the ranges before, one number a
    range, shifts the numbers. Neither the driver nor one task sees all values. Missing values have no place.
    """
    values = df.select(c).where(F.col(c).isNotNull()).distinct()
    ranges = values.repartitionByRange(c).sortWithinPartitions(c)
    numbered = stage(ranges.withColumn("__id", F.monotonically_increasing_id()), "vocabulary")
    numbered = numbered.select(c, F.shiftright("__id", 33).alias("__range"), F.col("__id").bitwiseAND((1 << 33) - 1).alias("__row"))
    counts = numbered.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = counts.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return stage(numbered.join(starts, "__range").select(c, (F.col("__start") + F.col("__row")).alias("index")), "vocabulary_index")


def sparse_one_hot(df: DataFrame, c: str, index: DataFrame, name: str = "one_hot", salt: str | None = None) -> DataFrame:
    """Add the sparse 0/1 vector of each row's value: a struct of ``size``, ``indices`` and ``values``.

    ``index`` comes from :func:`vocabulary_index`; its rows give the size. An unseen or missing value has no index. Long
    vocabularies are looked up by shuffle with hot values split, see ``lookup_join``.
    """
    size = index.count()
    found = lookup_join(df, index.withColumnRenamed("index", "__index"), [c], salt)
    at = F.col("__index")
    return found.select(*df.columns, F.struct(
        F.lit(size).cast("long").alias("size"),
        F.when(at.isNotNull(), F.array(at)).otherwise(F.array().cast("array<long>")).alias("indices"),
        F.when(at.isNotNull(), F.array(F.lit(1.0).cast("float"))).otherwise(F.array().cast("array<float>")).alias("values"),
    ).alias(name))
