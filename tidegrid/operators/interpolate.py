"""Linear interpolation by row position, with a two-sided cap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegrid.operators.blocks import BLOCK, BLOCK_ROWS, HALO, block_of, never

# Names of the columns that hold, for a measure, the last and the first valid cell of a
# group of rows, each as a struct of position and value.
Cells = dict[str, tuple[str, str]]
FOUND = ("prev", "next")


def _name(c: str, part: str) -> str:
    return f"__{c}_{part}"


def _neighbours(keys: Sequence[str], order: str, cells: Cells) -> dict[str, Column]:
    """Nearest valid cell before and after each row of ``keys``, the row itself excluded.

    The look ahead is a second running frame over the reversed order: a frame that is
    open towards the end would be recomputed for every row.
    """
    w = Window.partitionBy(*keys)
    past = w.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ahead = w.orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, -1)
    out = {_name(c, "prev"): F.last(last, True).over(past) for c, (last, _) in cells.items()}
    return out | {_name(c, "next"): F.last(first, True).over(ahead) for c, (_, first) in cells.items()}


def _with_nearest(df: DataFrame, keys: Sequence[str], order: str, cells: Cells, size: int, levels: int) -> DataFrame:
    """Add the nearest valid cells outside each row of a table of summaries.

    Below the top, rows look inside their block; what lies outside comes from the
    same search over the blocks' summaries, ``size`` times fewer rows per level.
    """
    if levels == 0:
        return df.withColumns(_neighbours(keys, order, cells))
    block = f"{BLOCK}{levels}"
    by = [*keys, block]
    grouped = df.withColumn(block, block_of(order, size))
    names = {c: (_name(c, "last"), _name(c, "first")) for c in cells}
    summary = grouped.groupBy(*by).agg(*[
        f(cell).alias(n) for c, own in cells.items() for f, cell, n in zip((F.max, F.min), own, names[c])])
    outer = _with_nearest(summary, keys, block, names, size, levels - 1).select(
        *by, *[F.col(_name(c, p)).alias(_name(c, "out_" + p)) for c in cells for p in FOUND])
    inner = grouped.withColumns(_neighbours(by, order, cells))
    return inner.join(outer, by, "left").select(*df.columns, *[
        F.coalesce(_name(c, p), _name(c, "out_" + p)).alias(_name(c, p)) for c in cells for p in FOUND])


def levels_for(longest: int, size: int) -> int:
    """Block levels after which the longest series is at most ``size`` summaries."""
    levels = 0
    while longest > size:
        longest, levels = -(-longest // size), levels + 1
    return levels


def _block_summaries(rows: DataFrame, by: Sequence[str], pos: str, cols: Sequence[str]) -> tuple[DataFrame, Cells]:
    """First and last position and valid cells per block, combined map-side.

    It asks for all columns, so that this side reads the exchange of the rows.
    """
    aggs, names = [F.min(pos).alias("__lo"), F.max(pos).alias("__hi")], {}
    for c in cols:
        at = F.when(F.col(c).isNotNull(), F.col(pos))
        aggs += [F.max(at).alias(f"__{c}_lp"), F.max_by(c, at).alias(f"__{c}_lv"),
                 F.min(at).alias(f"__{c}_fp"), F.min_by(c, at).alias(f"__{c}_fv")]
        names[c] = (_name(c, "last"), _name(c, "first"))
    found = rows.groupBy(*by).agg(*aggs, F.max(never(rows.columns, rows)).alias("__never")).where("NOT __never")

    def cell(c: str, p: str) -> Column:
        at = F.col(f"__{c}_{p}p")
        return F.when(at.isNotNull(), F.struct(at.alias("p"), F.col(f"__{c}_{p}v").alias("v")))

    return found.select(*by, "__lo", "__hi", *[
        cell(c, p).alias(n) for c in cols for p, n in zip("lf", names[c])]), names


def nearest_valid(
    df: DataFrame, keys: Sequence[str], pos: str, cols: Sequence[str],
    size: int = BLOCK_ROWS, longest: int | None = None,
) -> DataFrame:
    """Add, per column ``c``, the nearest valid cell on both sides of each row:
    ``__c_prev`` and ``__c_next``, structs of position ``p`` and value ``v``.

    Rows look inside their block. What the blocks before and behind it hold comes in as one row on
    each side, so nothing is joined to the panel; it is shuffled once, and the summaries of blocks read the same exchange.
    ``longest``, the row count of the longest series if known, says whether a block is enough, or summaries need
    blocks of their own.
    """
    kept = df.columns
    cells = {c: (_name(c, "at"), _name(c, "at")) for c in cols}
    at = {_name(c, "at"): F.when(F.col(c).isNotNull(), F.struct(F.col(pos).alias("p"), F.col(c).alias("v"))) for c in cols}
    found = [_name(c, p) for c in cols for p in FOUND]
    levels = 1 if longest is None else levels_for(longest, size)
    if levels == 0:
        rows = df.repartition(*keys).withColumns(at)  # helper columns are added behind the shuffle
        return rows.withColumns(_neighbours(keys, pos, cells)).select(*kept, *found)
    by = [*keys, BLOCK]
    rows = df.withColumn(BLOCK, block_of(pos, size)).repartition(*by)
    summary, names = _block_summaries(rows, by, pos, cols)
    outer = _with_nearest(summary, keys, BLOCK, names, size, levels - 1)
    marked = rows.withColumns(at).withColumn(HALO, never(rows.columns, rows))

    def border(order: Column, part: str) -> Column:
        return F.struct(order.alias(pos), *[F.col(_name(c, part)).alias(_name(c, "at")) for c in cols])

    borders = outer.select(*by, F.explode(F.array(
        border(F.col("__lo") - 1, "prev"), border(F.col("__hi") + 1, "next"))).alias("__border")).select(*by, "__border.*").repartition(*by)
    both = marked.unionByName(borders.withColumn(HALO, F.lit(True)), allowMissingColumns=True)
    return both.withColumns(_neighbours(by, pos, cells)).where(~F.col(HALO)).select(*kept, *found)


def interpolate(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    cols: Sequence[str],
    limit: int | None = 6,
    flag_suffix: str | None = None,
    size: int = BLOCK_ROWS,
    longest: int | None = None,
) -> DataFrame:
    """Fill missing cells on the line between their valid neighbours.

    ``limit`` fills only cells within that many rows of a valid cell on either
    side, so a long gap keeps a missing middle; ``None`` fills all. Before the first
    and after the last valid cell the nearest value is copied. Distances are row
    positions, not times. ``flag_suffix`` adds ``<c><suffix>``, true where filled.
    """
    found = nearest_valid(df, keys, pos, cols, size, longest)
    values, flags = {}, {}
    for c in cols:
        at = F.col(pos)
        pp, pv, np_, nv = (F.col(_name(c, part))[field] for part in FOUND for field in "pv")
        # without a neighbour on one side the slope is NULL and the other side's value is left
        line = F.coalesce(pv + (nv - pv) * (at - pp) / (np_ - pp), nv, pv)
        if limit is not None:
            line = F.when(F.least(at - pp, np_ - at) <= limit, line)
        values[c] = F.coalesce(F.col(c), line)
        if flag_suffix:
            flags[c + flag_suffix] = F.col(c).isNull() & line.isNotNull()
    return found.select(
        *[values[c].alias(c) if c in values else F.col(c) for c in df.columns],
        *[e.alias(n) for n, e in flags.items()],
    )


def fill_edges(df: DataFrame, keys: Sequence[str], pos: str, cols: Sequence[str],
               size: int = BLOCK_ROWS, longest: int | None = None) -> DataFrame:
    """Forward fill, then backward fill."""
    found = nearest_valid(df, keys, pos, cols, size, longest)
    filled = {c: F.coalesce(F.col(c), F.col(_name(c, "prev"))["v"], F.col(_name(c, "next"))["v"]) for c in cols}
    return found.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])
