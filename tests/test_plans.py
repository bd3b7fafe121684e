"""The physical plans the design promises."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidegrid.operators.densify import densify
from tidegrid.operators.interpolate import interpolate
from tidegrid.operators.rolling import rolling_features
from tidegrid.operators.strided import score_blocks_with
from tidegrid.operators.windows import last_step_pairs, sliding_windows
from tidegrid.plans.dataset import long_windows, manifest_long
from tidegrid.plans.spec import PanelSpec
from tidegrid.sources import stage as staging
from tidegrid.sources.files import read_clean, write_clean


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clean") / "panel")
    df = spark.range(300).select(
        F.lit("a").alias("series"), "id", F.col("id").alias("pos"),
        F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + INTERVAL '1' HOUR * id").alias("t"),
        F.col("id").cast("double").alias("m1"), F.col("id").cast("double").alias("m1_norm"),
        F.when(F.col("id") < 200, "train").otherwise("val").alias("split"),
    )
    write_clean(df, path)
    return read_clean(spark, path)


def test_long_windows_take_one_exchange_and_one_sort(clean):
    spec = PanelSpec(measures=("m1",), target="m1", dense=True)
    text = plan(long_windows(clean, spec, manifest_long(spec, ["a"])))
    assert text.count("Exchange hashpartitioning(split") == text.count("Exchange") == 1
    assert text.count("Sort [") == 1
    assert "__block" in text.split("Exchange hashpartitioning(")[1].split(")")[0]


def final_plan(df):
    """The plan that ran, without what was written for it at first."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("holes", ["true", "pos % 7 <> 3", "pos % 40 < 9"])
@pytest.mark.parametrize("columns", [["series", "pos", "f"], ["f"], ["series", "t", "m1", "f"]])
def test_row_frames_run_their_input_once(clean, holes, columns):
    rows = clean.where(holes)
    text = final_plan(rolling_features(rows, ["series"], "pos", {"f": ("m1", "mean", 12)}, size=50).select(*columns))
    assert text.count("FileScan") == 1
    assert ("Generate explode(transform" in text) == (holes != "true")  # rows are looked up only where there are holes


def test_nothing_starts_before_a_row_frame_is_asked_for(spark, clean):
    spark.sparkContext.setJobGroup("lazy", "lazy")
    try:
        rolling_features(clean, ["series"], "pos", {"f": ("m1", "mean", 12)}, size=50)
        interpolate(clean, ["series"], "pos", ["m1"])
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_the_grid_is_shuffled_once_up_to_the_filled_panel(clean):
    """Cells and one row a block are dealt out, the grid grows behind that, and the panel moves once, for the fill."""
    cells = clean.where("id % 3 = 0").select("series", "t", "m1", "split")
    text = final_plan(interpolate(densify(cells, ["series"], "t", 3600), ["series"], "pos", ["m1"]))
    assert "SortMergeJoin" not in text.split("array_except")[0]  # nothing is joined to grown rows
    grown = text.index("array_except")
    above = [line for line in text[:grown].splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
    assert len([line for line in above if "REPARTITION_BY_COL" in line and "__lo" not in line]) <= 2


def test_a_split_is_read_from_its_own_files_and_columns(clean):
    text = plan(clean.where("split = 'val'").select("m1"))
    assert "PartitionFilters: [isnotnull(split" in text and "ReadSchema: struct<m1:double>" in text


def test_baseline_pairs_do_not_build_tensors(clean):
    args = (clean, ["series"], "pos", "t", ["m1_norm"], 24, "m1_norm", "m1")
    assert "collect_list" in plan(sliding_windows(*args, dense=True))
    assert "collect_list" not in plan(last_step_pairs(*args, dense=True))
    scored = score_blocks_with(*args[:6], lambda x: x[:, 0, 0], dense=True)
    assert "collect_list" not in plan(scored) and plan(scored).count("Exchange") == 1


def test_staged_tables_can_be_cleared(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(staging, "_created", [])
    monkeypatch.setattr(staging, "stage_dir", lambda spark: str(tmp_path))
    staging.stage(spark.range(3), "one")
    assert len(list((tmp_path / "tidegrid").iterdir())) == 1
    assert staging.clear_stages(spark) == 1 and not list((tmp_path / "tidegrid").iterdir())
