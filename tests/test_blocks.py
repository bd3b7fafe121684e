"""Halo blocks, positions and grids."""

from __future__ import annotations

import pytest
from pyspark.sql import Window, functions as F

from tidegrid.functions.calendar import epoch_seconds, floor_to_step, from_epoch_seconds
from tidegrid.operators.blocks import BLOCK, over_blocks, with_halo, with_position
from tidegrid.operators.densify import densify
from tidegrid.operators.rolling import rolling_features

FEATURES = {"l3": ("m1", "lag", 3), "mean4": ("m1", "mean", 4), "std3": ("m1", "std", 3),
            "max5": ("m1", "max", 5), "d1": ("m1", "diff", 1)}


def table(df, cols):
    return {(r["series"], r["pos"]): tuple(r[c] for c in cols) for r in df.collect()}


@pytest.mark.parametrize("size", [5, 7, 8192])
def test_features_are_those_of_the_unsplit_window(panel, size):
    series = {"a": [float(i * i % 17) if i % 4 else None for i in range(53)], "b": [1.0], "hot": [float(i % 9) for i in range(200)]}
    df = panel(series)
    w = Window.partitionBy("series").orderBy("pos")
    want = df.select(
        "series", "pos",
        F.coalesce(F.lag("m1", 3).over(w), F.lit(0.0)).alias("l3"),
        F.avg("m1").over(w.rowsBetween(-3, 0)).alias("mean4"),
        F.coalesce(F.stddev_samp("m1").over(w.rowsBetween(-2, 0)), F.lit(0.0)).alias("std3"),
        F.max("m1").over(w.rowsBetween(-4, 0)).alias("max5"),
        F.coalesce(F.col("m1") - F.lag("m1", 1).over(w), F.lit(0.0)).alias("d1"),
    )
    got = table(rolling_features(df, ["series"], "pos", FEATURES, size=size), FEATURES)
    want = table(want, FEATURES)
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key])


def test_a_block_holds_at_most_its_size_and_the_halo(panel):
    df = with_halo(panel({"hot": [1.0] * 1000}), "pos", before=6, size=50)
    sizes = [r["count"] for r in df.groupBy("series", BLOCK).count().collect()]
    assert max(sizes) == 56 and len(sizes) == 21


def test_frames_longer_than_a_block_are_refused_no_more(panel):
    df = panel({"a": [float(i) for i in range(40)]})
    got = over_blocks(df, ["series"], "pos", 25, lambda d, w: d.withColumn("x", F.sum("m1").over(w.rowsBetween(-25, 0))), size=10)
    assert {r["pos"]: r["x"] for r in got.collect()} == {i: float(sum(range(max(0, i - 25), i + 1))) for i in range(40)}


@pytest.mark.parametrize("keep", ["pos % 7 <> 3", "pos % 50 > 44", "pos NOT BETWEEN 21 AND 130", "pos > 33 AND pos % 3 = 0"])
@pytest.mark.parametrize("size", [5, 30, 8192])
def test_holes_in_the_positions_change_nothing(panel, keep, size):
    df = panel({"a": [float(i % 17) for i in range(200)], "b": [float(i) for i in range(20)]}).where(keep)
    w = Window.partitionBy("series").orderBy("pos")
    want = {(r["series"], r["pos"]): r["x"] for r in df.select(
        "series", "pos", F.collect_list("m1").over(w.rowsBetween(-12, 0)).alias("x")).collect()}
    got = over_blocks(df, ["series"], "pos", 12, lambda d, v: d.withColumn("x", F.collect_list("m1").over(v.rowsBetween(-12, 0))), size=size)
    assert {(r["series"], r["pos"]): r["x"] for r in got.collect()} == want


@pytest.mark.parametrize("size", [2, 24, 8192])
def test_positions_follow_time_with_holes(spark, size):
    hours = {"a": [0, 1, 5, 6, 30, 31, 100], "b": [50], "c": list(range(40))}
    df = spark.createDataFrame([(s, h) for s, hs in hours.items() for h in hs], "series string, h int").selectExpr(
        "*", "TIMESTAMP_NTZ '2024-03-30 20:00:00' + INTERVAL '1' HOUR * h AS t"
    ).repartition(3)
    got = {(r["series"], r["h"]): r["pos"] for r in with_position(df, ["series"], "t", size=size).collect()}
    assert got == {(s, h): i for s, hs in hours.items() for i, h in enumerate(hs)}


@pytest.mark.parametrize("size", [3, 8192])
def test_grid_has_every_step_once(spark, size):
    df = spark.sql(
        "SELECT * FROM VALUES ('a', TIMESTAMP_NTZ '2024-01-01 03:00:00', 1.0D), "
        "('a', TIMESTAMP_NTZ '2024-01-01 10:00:00', 2.0D), ('b', TIMESTAMP_NTZ '2024-01-01 05:00:00', 3.0D) "
        "AS v(series, t, m1)"
    )
    common = densify(df, ["series"], "t", 3600, span="common", size=size)
    assert common.groupBy("series").count().collect() and common.count() == 16
    assert common.where("m1 IS NOT NULL").count() == 3
    own = densify(df, ["series"], "t", 3600, size=size)
    assert {r["series"]: r["count"] for r in own.groupBy("series").count().collect()} == {"a": 8, "b": 1}
    first = own.where("pos = 0").select("series", F.hour("t").alias("h")).collect()
    assert {r["series"]: r["h"] for r in first} == {"a": 3, "b": 5}


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_time_arithmetic_ignores_the_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # an hour that does not exist in Berlin, a leap day, and a time before 1970
        row = spark.sql(
            "SELECT TIMESTAMP_NTZ '2024-03-31 02:30:15.5' a, TIMESTAMP_NTZ '2024-02-29 23:59:59' b, "
            "TIMESTAMP_NTZ '1969-12-31 23:00:00.25' c"
        )
        out = row.select(
            epoch_seconds("a"), epoch_seconds("b"), epoch_seconds("c"),
            floor_to_step("a", 3600).cast("string"), from_epoch_seconds(F.lit(-3600)).cast("string"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert tuple(out) == (1711852215, 1709251199, -3600, "2024-03-31 02:00:00", "1969-12-31 23:00:00")


def test_rows_between_steps_keep_their_values_and_two_for_a_step_fail(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 90, 2.0), ("a", 180, 3.0)], "series string, m int, m1 double").selectExpr(
        "series", "TIMESTAMP_NTZ '2024-01-01 00:00:00' + INTERVAL '1' MINUTE * m AS t", "m1")
    rows = {r["pos"]: (str(r["t"]), r["m1"]) for r in densify(df, ["series"]).collect()}
    assert rows == {0: ("2024-01-01 00:00:00", 1.0), 1: ("2024-01-01 01:00:00", 2.0), 2: ("2024-01-01 02:00:00", None), 3: ("2024-01-01 03:00:00", 3.0)}
    with pytest.raises(Exception, match="several rows for one step"):
        densify(df.unionByName(df), ["series"]).collect()
