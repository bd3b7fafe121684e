"""Sources, sinks and stored parameters."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidegrid.functions.calendar import with_timestamp
from tidegrid.plans.dataset import Manifest
from tidegrid.sources.files import (
    cached_windows, panel_schema, read_panel, read_predictions, write_predictions, write_windows,
)
from tidegrid.sources import params
from tidegrid.sources.params import (
    load_manifest, load_scaler_by_series, read_metrics, save_manifest, save_scaler_by_series, upsert_metrics,
)
from tidegrid.sources.stage import one_row, stage, stage_dir

HEADER = "year,month,day,hour,PM2.5,PM10,SO2,NO2,CO,O3,TEMP,PRES,DEWP,RAIN,WSPM,wd,station"


def test_raw_panel_csv(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(
        HEADER + "\n2013,3,1,0,4,NA,NaN,7,300,77,-0.7,1023,-18.8,0,4.4,NNW,Alpha\n"
        "2013,3,1,1,,8,4,7,300,77,-1.1,1023.2,-18.2,0,4.7,NA,Alpha\n"
    )
    rows = with_timestamp(read_panel(spark, str(tmp_path / "raw.csv"))).orderBy("t").collect()
    assert (rows[0]["pm25"], rows[0]["pm10"], rows[0]["so2"]) == (4.0, None, None)
    assert (rows[1]["pm25"], rows[1]["wd"], rows[1]["station"]) == (None, None, "Alpha")
    assert str(rows[1]["t"]) == "2013-03-01 01:00:00"


def test_columns_in_another_order_are_noticed(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(HEADER.replace("PM2.5,PM10", "PM10,PM2.5") + "\n" + "1," * 16 + "a\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_panel(spark, str(tmp_path / "raw.csv")).collect()


def test_prediction_files_keep_the_dotted_header(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), ("b", 0.0)], "id string, pred double").coalesce(1)
    write_predictions(df, str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*.csv")).read_text()
    assert text.splitlines() == ["id,PM2.5", "a,1.5", "b,0.0"]
    assert sorted(map(tuple, read_predictions(spark, str(tmp_path / "out")).collect())) == [("a", 1.5), ("b", 0.0)]


def test_blend_files_are_split_by_weight(spark, tmp_path):
    df = spark.createDataFrame([(0.5, "a", 1.0), (0.7, "a", 2.0)], "w double, id string, pred double")
    write_predictions(df, str(tmp_path / "grid"), partition_by=["w"])
    assert sorted(p.name for p in (tmp_path / "grid").glob("w=*")) == ["w=0.5", "w=0.7"]
    assert read_predictions(spark, str(tmp_path / "grid" / "w=0.7")).first()["pred"] == 2.0


def windows(spark, value):
    return spark.createDataFrame([("train", [[value]])], "split string, x array<array<float>>")


def test_cache_builds_once_and_again_after_an_unfinished_write(spark, tmp_path):
    path, calls = str(tmp_path / "cache"), []

    def build(value):
        def run():
            calls.append(value)
            return windows(spark, value)
        return run

    assert cached_windows(spark, path, build(1.0)).first()["x"] == [[1.0]]
    assert cached_windows(spark, path, build(2.0)).first()["x"] == [[1.0]]
    (tmp_path / "cache" / "_SUCCESS").unlink()
    assert cached_windows(spark, path, build(3.0)).first()["x"] == [[3.0]]
    assert calls == [1.0, 3.0]


def test_cache_is_built_again_for_other_settings_and_changed_input(spark, tmp_path):
    path, source, calls = str(tmp_path / "cache"), str(tmp_path / "in put"), []
    spark.range(3).write.parquet(source)

    def stored(value, **spec):
        def build():
            calls.append(value)
            return windows(spark, value)
        return cached_windows(spark, path, build, spec, [spark.read.parquet(source)]).first()["x"][0][0]

    manifest = {"features": ["a", "b"], "window": 24}
    assert [stored(1.0, manifest=manifest), stored(2.0, manifest=dict(reversed(manifest.items())))] == [1.0, 1.0]
    assert stored(3.0, manifest={**manifest, "window": 48}) == 3.0
    spark.range(5).write.mode("append").parquet(source)
    assert [stored(4.0, manifest={**manifest, "window": 48}), stored(5.0, manifest={**manifest, "window": 48})] == [4.0, 4.0]
    (tmp_path / "cache" / "_spec").unlink()
    assert stored(6.0, manifest={**manifest, "window": 48}) == 6.0
    assert calls == [1.0, 3.0, 4.0, 6.0]


def test_two_writers_of_metrics_lose_nothing(spark, tmp_path, monkeypatch):
    path, commit, rivals = str(tmp_path / "metrics"), params._commit, ["b", "c"]

    def record(name):
        return spark.createDataFrame([(name, 1.0, 2.0, 3.0)], params.METRICS)

    def late(spark, written, version):
        if rivals:  # another writer is done between this one's reading and its commit
            upsert_metrics(spark, path, record(rivals.pop()))
        return commit(spark, written, version)

    monkeypatch.setattr(params, "_commit", late)
    upsert_metrics(spark, path, record("a"))
    assert {r["model"] for r in read_metrics(spark, path).collect()} == {"a", "b", "c"}
    assert sorted(p.name for p in (tmp_path / "metrics").iterdir() if p.is_dir()) == ["version=1", "version=2", "version=3"]


def test_windows_are_not_overwritten_by_accident(spark, tmp_path):
    write_windows(windows(spark, 1.0), str(tmp_path / "w"))
    with pytest.raises(Exception, match="(?i)exist"):
        write_windows(windows(spark, 2.0), str(tmp_path / "w"))


def test_manifest_and_scaler_files(spark, tmp_path):
    manifest = Manifest(["b", "a"], ["s1", "s2"], 24)
    save_manifest(spark, manifest, str(tmp_path / "m"))
    assert load_manifest(spark, str(tmp_path / "m")) == manifest
    df = spark.createDataFrame([("x", 1.0, 2.0)], "station string, q_mu double, q_sigma double")
    save_scaler_by_series(df, "station", ["q"], str(tmp_path / "s"))
    assert load_scaler_by_series(spark, "station", ["q"], str(tmp_path / "s")).collect() == df.collect()


def test_metric_records(spark, tmp_path):
    path = str(tmp_path / "metrics")
    assert read_metrics(spark, path).count() == 0
    record = lambda m, r: spark.createDataFrame([(m, r, 1.0, 9.0)], "model string, rmse double, mae double, seconds double")
    upsert_metrics(spark, path, record("ffn", 2.0))
    upsert_metrics(spark, path, record("gru", 3.0))
    out = upsert_metrics(spark, path, record("ffn", 1.0))
    assert {r["model"]: r["rmse"] for r in out.collect()} == {"ffn": 1.0, "gru": 3.0}


def test_staging_uses_the_shared_folder_and_cuts_the_plan(spark):
    assert stage_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    df = spark.range(10).select(F.col("id"), (F.col("id") % 2).cast("string").alias("split"), F.lit(1).alias("z"))
    back = stage(df, "test", ["split"])
    assert back.columns == df.columns and back.where("split = '1'").count() == 5
    assert any(stage_dir(spark) in f for f in back.inputFiles())


def test_parameters_are_one_row(spark):
    assert one_row(spark.range(1)) == {"id": 0}
    with pytest.raises(ValueError, match="exactly one"):
        one_row(spark.range(2))


def test_schema_of_another_panel():
    assert panel_schema(["q"], wind=None, series="site").names == ["year", "month", "day", "hour", "q", "site"]


def test_stored_windows_of_a_grid_count_no_rows_beforehand(spark, tmp_path):
    """Every step of the grid is there, so blocks need not be counted to know what halos lack."""
    from panel_queries.q_io import _split_windows

    at = F.timestamp_seconds(F.col("id") * 7200 + 1_706_000_000).cast("timestamp_ntz")
    events = spark.range(60).select(
        F.col("id").alias("event_id"), at.alias("ts"), (F.col("id") % 2).alias("user_id"), F.lit("view").alias("event_type"),
        F.col("id").cast("double").alias("value"), F.lit('{"k": 3}').alias("props"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    wins = _split_windows(spark, str(tmp_path))
    assert "__feeds" not in wins._jdf.queryExecution().toString()
    assert wins.count() == 2 * (119 - 24)
