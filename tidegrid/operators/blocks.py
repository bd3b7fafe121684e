"""Row-frame windows over long series, split into bounded blocks.

``Window.partitionBy(series)`` puts a whole series into one task, so one series
that holds a third of the data stops the job. Every row-frame operator here runs
over ``(series, block)`` instead, where a block is ``BLOCK_ROWS`` consecutive
positions. Rows a frame needs from earlier blocks are copied in as a *halo*
and dropped afterwards, so the result is the one of the unsplit window.

Frames count rows, not positions, and ``pos`` may have holes. Halos are copied by position, and what holes leave missing
is found where the rows meet and taken from the same exchange: the input runs once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidegrid.functions.calendar import epoch_seconds
from tidegrid.operators.shares import bounded_shares

BLOCK_ROWS = 8192
BLOCK = "__block"
HALO = "__halo"
HOME = "__home"  # a hash of series and block, by which blocks are dealt out


def block_of(pos: str | Column, size: int = BLOCK_ROWS) -> Column:
    pos = F.col(pos) if isinstance(pos, str) else pos
    return F.floor(pos / size)


def with_halo(df: DataFrame, pos: str, before: int, size: int = BLOCK_ROWS) -> DataFrame:
    """Assign blocks and copy the rows at the last ``before`` positions of each block into the next one."""
    own = block_of(pos, size)
    feeds_next = F.pmod(F.col(pos), F.lit(size)) >= size - before
    blocks = F.when(feeds_next, F.array(own, own + 1)).otherwise(F.array(own))
    return df.select(*df.columns, F.explode(blocks).alias(BLOCK)).withColumn(HALO, F.col(BLOCK) != own)


def never(columns: Sequence[str], df: DataFrame) -> Column:
    """False for every row, which Spark cannot know: it keeps all columns in the exchange below, so that branches share it."""
    hashed = [f.name for f in df.schema if f.name in columns and "map<" not in f.dataType.simpleString()]
    return F.bit_count(F.xxhash64(*hashed)) < 0


def missing_halo(counts: DataFrame, keys: Sequence[str], before: int) -> DataFrame:
    """Which rows blocks still need, as ``(HOME, __feeds)``: by source block the targets and the ranks they take.

    ``counts`` holds the own rows (``__n``) and the copied ones (``__have``) of each block. Copies are the last rows
    in front of a block; where they are fewer than ``before``, older ones are missing. Ranks count from a source's last row. Tails of
    ``before`` rows at most are enough to find the sources: a range over their running size holds them. Without holes the table is empty.
    """
    series = Window.partitionBy(*keys)
    earlier = series.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("__start", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    placed = placed.withColumn("__tails", F.coalesce(F.sum(F.least("__n", F.lit(before))).over(earlier), F.lit(0)))
    near = series.orderBy("__tails").rangeBetween(1 - 2 * before, -1)
    sources = F.collect_list(F.struct(HOME, F.struct(*keys, BLOCK).alias("__from"), "__start", "__n")).over(near)
    need = F.least(F.col("__start"), F.lit(before))
    short = placed.withColumn("__sources", sources).where(F.col("__have") < need)
    feeds = short.select(F.col(BLOCK).alias("__to"), "__have", need.alias("__need"), F.col("__start").alias("__at"),
                         F.inline("__sources"))
    gap = F.col("__at") - F.col("__start") - F.col("__n")
    return feeds.select(HOME, F.struct(
        "__from", "__to", (F.col("__have") - gap).alias("above"), F.least(F.col("__need") - gap, "__n").alias("upto")).alias("__feed")).where(
        "__feed.upto > 0 AND __feed.upto > __feed.above").groupBy(HOME).agg(F.collect_list("__feed").alias("__feeds"))


def with_last_rows(df: DataFrame, keys: Sequence[str], pos: str, before: int, size: int = BLOCK_ROWS) -> DataFrame:
    """Assign blocks and give each one the last ``before`` rows in front of it, whatever blocks they stand in.

    Rows at the last positions of a block are copied before they are dealt out. Whether that was enough is
    counted where they meet, block by block; rows that are still missing come from the same exchange, so
    the input runs once and nothing is counted beforehand. Where nothing is missing, that part ends as an empty table.
    """
    by, columns = [HOME, *keys, BLOCK], df.columns
    own = block_of(pos, size)
    rows = with_halo(df, pos, before, size).drop(HALO).withColumn(HOME, F.xxhash64(*keys, BLOCK)).repartition(HOME)
    copied = F.col(BLOCK) != own
    counts = rows.groupBy(*by).agg(
        F.count_if(~copied).alias("__n"), F.count_if(copied).alias("__have"),
        F.max(never(columns, df)).alias("__never"))
    feeds = missing_halo(counts.where("__n > 0 AND NOT __never"), keys, before)
    newest = Window.partitionBy(*by).orderBy(F.col(pos).desc())
    ranked = rows.join(feeds, HOME).withColumn("__rank", F.row_number().over(newest)).where(F.col("__rank") <= before)
    rank = F.col("__rank")
    source = F.struct(*keys, BLOCK)  # compared whole, as hashes may meet
    takers = F.filter("__feeds", lambda f: (f["above"] < rank) & (rank <= f["upto"]) & f["__from"].eqNullSafe(source))
    more = ranked.select(*columns, F.explode(F.transform(takers, lambda f: f["__to"])).alias(BLOCK))
    more = more.withColumn(HOME, F.xxhash64(*keys, BLOCK)).repartition(HOME)
    return rows.withColumn(HALO, copied | never(columns, df)).unionByName(more.withColumn(HALO, ~never(columns, df)))


def blocked(df: DataFrame, keys: Sequence[str], pos: str, before: int, size: int = BLOCK_ROWS,
            dense: bool = False) -> tuple[DataFrame, list[str]]:
    """Rows with their ``BLOCK`` and whether they are ``HALO``, and the columns by which blocks lie in tasks; see :func:`over_blocks`."""
    df = bounded_shares(df)
    if not before:
        return df.withColumn(BLOCK, block_of(pos, size)).withColumn(HALO, F.lit(False)), [*keys, BLOCK]
    if dense:
        return with_halo(df, pos, before, max(size, before)), [*keys, BLOCK]
    return with_last_rows(df, keys, pos, before, max(size, before)), [HOME, *keys, BLOCK]


def over_blocks(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    before: int,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    size: int = BLOCK_ROWS,
    dense: bool = False,
) -> DataFrame:
    """Run ``build(df, window)`` per block; frames may reach ``before`` rows back.

    Operators that feed each other can be built in one call with the sum of their
    frame lengths as ``before``: they then share one exchange and one sort. A block
    has at least ``before`` positions. ``dense`` states that ``pos`` has no holes, as
    when it was numbered just before: then nothing is counted.
    """
    rows, by = blocked(df, keys, pos, before, size, dense)
    done = build(rows, Window.partitionBy(*by).orderBy(pos))
    return done.where(~F.col(HALO)).drop(BLOCK, HALO, HOME)


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    t: str,
    step_seconds: int = 3600,
    pos: str = "pos",
    size: int = BLOCK_ROWS,
) -> DataFrame:
    """Number the rows of each series in time order from 0.

    Rows are counted per time slice of ``size`` steps; the slices' running totals,
    one number per slice, shift the numbering inside each slice.
    """
    sliced = df.withColumn(BLOCK, F.floor(epoch_seconds(t) / (step_seconds * size)))
    counts = sliced.groupBy(*keys, BLOCK).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *keys, BLOCK, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start")
    )
    inside = Window.partitionBy(*keys, BLOCK).orderBy(t)
    return (
        sliced.join(starts, [*keys, BLOCK])
        .withColumn(pos, F.col("__start") + F.row_number().over(inside) - 1)
        .drop(BLOCK, "__start")
    )
