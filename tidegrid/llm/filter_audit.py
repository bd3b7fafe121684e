"""What each filter of a chain removes, in every order of the chain.

A text fails some of the filters, which is a set of a few bits. All orders of the filters, and all steps in them, follow
from how many rows of a part fail each set: a step removes the sets that hold its filter
and none of those before it. So rows are counted once, and orders are applied to the counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegrid.llm.batches import small_batches
from tidegrid.llm.text_bytes import byte_rows
from tidegrid.llm.transducer import FIELDS, text_counts
from tidegrid.sources.stage import stage

LONGEST = 7


def document_counts(docs: DataFrame, text_col: str, columns: dict[str, Column]) -> DataFrame:
    """``columns``, ``FIELDS`` of each text by the transducer, and ``__sha256`` of its bytes. A null text is empty."""
    carried = docs.select(F.col(text_col).alias("__text"), *[c.alias(name) for name, c in columns.items()])
    kept = carried.schema[1:]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = byte_rows(batch.column(0))
            counts, whole = text_counts(data, at), memoryview(data)
            digests = [hashlib.sha256(whole[a:b]).digest() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *[pa.array(counts[:, i]) for i in range(len(FIELDS))], pa.array(digests, pa.binary())],
                [*batch.schema.names[1:], *FIELDS, "__sha256"])

    fields = ", ".join(f"{f} long" for f in FIELDS)
    return small_batches(carried).mapInArrow(run, f"{schema}, {fields}, __sha256 binary")


def with_earlier_copies(rows: DataFrame, id_col: str, copy_of: Sequence[str], bit: int) -> DataFrame:
    """Counted rows, with ``bit`` set in ``__mask`` for those that a row with a smaller id equals in ``copy_of``.

    ``rows`` are staged and hold the columns ``__mask``, ``__n`` and others; rows that agree in all but ``__n``
    come as one. No group of copies meets in a task: the smallest id of each is found by an aggregation
    and joined by group and id, so only the rows with that id have its key. The result no longer holds ids.
    """
    others = [c for c in rows.columns if c not in (id_col, *copy_of, "__n")]
    smallest = rows.where(F.col(id_col).isNotNull()).groupBy(*copy_of).agg(F.min(id_col).alias(id_col))
    first = rows.join(smallest, [*copy_of, id_col], "left_semi").unionByName(rows.where(F.col(id_col).isNull()))
    # every row counts as a copy, and the first ones are taken back
    signed = rows.withColumn("__copies", F.col("__n")).withColumn("__firsts", F.lit(0).cast("long")).unionByName(
        first.withColumn("__copies", -F.col("__n")).withColumn("__firsts", F.col("__n")))
    sums = signed.groupBy(*others).agg(F.sum("__copies").alias("__copies"), F.sum("__firsts").alias("__firsts"))
    each = F.array(F.struct(F.col("__mask").alias("mask"), F.col("__firsts").alias("n")),
                   F.struct(F.col("__mask").bitwiseOR(F.lit(bit)).alias("mask"), F.col("__copies").alias("n")))
    rest = [c for c in others if c != "__mask"]
    return sums.select(*rest, F.explode(each).alias("__each")).where("__each.n > 0").select(
        *rest, F.col("__each.mask").alias("__mask"), F.col("__each.n").alias("__n"))


def order_steps(letters: str) -> list[tuple[str, int, int, int]]:
    """Every order of the filters and every step in it: the order, the step from 1, its filter's bit, the bits before it."""
    steps = []
    for order in permutations(letters):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << letters.index(letter)
            steps.append(("".join(order), step, bit, before))
            before |= bit
    return steps


def audit_orders(counted: DataFrame, letters: str, part: str = "part", weights: Sequence[str] = ()) -> DataFrame:
    """What every step of every order of filters keeps and removes, by part.

    ``counted`` has rows ``(part, __mask, __n)``, where bit ``i`` of ``__mask`` says that the rows fail filter ``letters[i]``;
    ``weights`` are further columns with numbers of rows among them. Per part, ``filter_order`` and
    ``step`` come ``kept``, ``removed`` (here), ``redundant`` (fail the filter, but were removed before), ``unique_fails``
    (fail it alone), ``<weight>_lost`` (of each weight, removed here) and ``shapley``: the filter's removals summed
    over all orders. A row that fails ``k`` filters is removed by each in ``1 / k`` of the orders, so that sum
    needs no orders. At most 7 filters; no rows give no parts.
    """
    if not 1 <= len(letters) <= LONGEST or len(set(letters)) < len(letters):
        raise ValueError(f"1 to {LONGEST} different letters name the filters")
    sums = counted.groupBy(part, "__mask").agg(*[F.sum(c).alias(c) for c in ("__n", *weights)])
    cells = sums.groupBy(part).agg(F.collect_list(F.struct("__mask", "__n", *weights)).alias("__cells"))
    steps = order_steps(letters)
    table = counted.sparkSession.createDataFrame(
        [(k, *s) for k, s in enumerate(steps)], "__k int, filter_order string, step int, __bit int, __before int")
    every = cells.withColumn("__k", F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1))))
    rows = every.join(F.broadcast(table), "__k")
    bit, before = F.col("__bit"), F.col("__before")

    def total(value, holds) -> Column:
        return F.aggregate("__cells", F.lit(0).cast("long"),
                           lambda n, c: n + F.when(holds(c["__mask"]), value(c)).otherwise(F.lit(0)).cast("long"))

    def n(c: Column) -> Column:
        return c["__n"]

    def none(mask: Column, bits: Column) -> Column:
        return mask.bitwiseAND(bits) == 0

    def removed(mask: Column) -> Column:
        return none(mask, before) & ~none(mask, bit)

    orders = factorial(len(letters))
    return rows.select(
        part, "filter_order", "step",
        total(n, lambda m: none(m, before.bitwiseOR(bit))).alias("kept"),
        total(n, removed).alias("removed"),
        total(n, lambda m: ~none(m, before) & ~none(m, bit)).alias("redundant"),
        total(n, lambda m: m == bit).alias("unique_fails"),
        *[total(lambda c, w=w: c[w], removed).alias(f"{w}_lost") for w in weights],
        total(lambda c: c["__n"] * F.floor(F.lit(orders) / F.bit_count(c["__mask"])), lambda m: ~none(m, bit)).alias("shapley"))


def audit_filters(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "source") -> DataFrame:
    """Interactions of five filters over whole texts, by ``part``, in all 120 orders.

    A: under 200 words; B: fewer distinct words than half of the words; C: capitals A-Z above 2 percent of the code
    points; D: any of ``#$%&*|``; E: equal to a text with a smaller id anywhere in the table. Words are maximal
    runs without ASCII white space, case-sensitive. Columns as in :func:`audit_orders`, with
    ``good_lost`` and ``toxic_lost`` from ``labels`` (``quality`` and ``toxic`` of 1; any of an id's rows).

    A null text is empty, a null part the empty string. Rows with the same id are not copies of each other; a row
    without an id is a copy of none and has no label. Texts of any length are read in parts. An empty table gives
    no rows. Labels of other ids and other columns are ignored.
    """
    counts = document_counts(docs, text_col, {"__id": F.col(id_col), "part": F.coalesce(F.col(part_col).cast("string"), F.lit(""))})
    fails = [F.col("n_words") < 200, 100 * F.col("n_distinct") < 50 * F.col("n_words"),
             100 * F.col("n_capitals") > 2 * F.col("n_points"), F.col("n_symbols") > 0]
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    alike = stage(counts.select("__id", "part", "__sha256", mask.alias("__mask")).groupBy(
        "__id", "part", "__sha256", "__mask").agg(F.count(F.lit(1)).alias("__n")), "audited")
    flags = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("__good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("__toxic")).where("__good + __toxic > 0")
    # rows without an id match no label, and would all go to one task
    known = alike.where(F.col("__id").isNotNull()).join(flags, "__id", "left")
    nameless = alike.where(F.col("__id").isNull()).withColumns({"__good": F.lit(None).cast("int"), "__toxic": F.lit(None).cast("int")})
    rows = stage(known.unionByName(nameless).fillna(0, ["__good", "__toxic"]), "labelled")
    counted = with_earlier_copies(rows, "__id", ["__sha256"], 1 << 4)
    weighted = counted.withColumns({"good": F.col("__n") * F.col("__good"), "toxic": F.col("__n") * F.col("__toxic")})
    return audit_orders(weighted, "ABCDE", weights=("good", "toxic"))
