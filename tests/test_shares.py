"""What a task gets does not grow with the tables."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tidegrid.llm.word_encoder import WordEncoder
from tidegrid.operators import shares
from tidegrid.operators.blend import align_predictions, blend_mean
from tidegrid.operators.densify import densify
from tidegrid.operators.windows import sliding_windows
from tidegrid.sources import files


@pytest.fixture
def settings(spark):
    names = [shares.PARTS, *shares.LIMITS]
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.unset(n)
    yield spark.conf
    for n, value in before.items():
        spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_settings_are_only_tightened(spark, settings):
    advised, read = shares.LIMITS
    settings.set(advised, "1m")
    own = int(settings.get(shares.DEFAULT_PARTS))
    shares.bounded_shares(spark.range(1), shares.TASK_ROWS * (own + 3))
    assert settings.get(advised) == "1m" and settings.get(read) == str(shares.LIMITS[read])
    assert settings.get(shares.PARTS) == str(own + 3)
    shares.bounded_shares(spark.range(1), 5)
    assert settings.get(shares.PARTS) == str(own + 3)


def test_a_long_grid_gets_more_tasks(spark, settings, monkeypatch):
    monkeypatch.setattr(shares, "TASK_ROWS", 50)
    cells = spark.range(2).select(F.lit("a").alias("s"), F.timestamp_seconds(F.col("id") * 3600 * 999).cast("timestamp_ntz").alias("t"),
                                  F.lit(1.0).alias("m"))
    grid = densify(cells, ["s"], "t", 3600, size=100)
    assert grid.count() == 1000 and grid.where("m IS NOT NULL").count() == 2
    counts = {int(n) for n in re.findall(r"hashpartitioning\(.*?, (\d+)\), REPARTITION_BY_NUM", plan(grid))}
    assert counts == {20} and settings.get(shares.PARTS) == "20"


def test_ids_are_dealt_out_before_they_are_added_up(spark, settings):
    a = spark.range(4).select(F.col("id").cast("string").alias("id"), F.lit(1.0).alias("pred"))
    for df in (align_predictions(a, a), blend_mean(a, a, a)):
        for below in plan(df).split("REPARTITION_BY_COL")[1:]:
            assert "Aggregate" not in below.split("+- Exchange")[0].split("HashAggregate")[0]
        assert "REPARTITION_BY_COL" in plan(df) and "ENSURE_REQUIREMENTS" not in plan(df)
    assert {r["pred"] for r in blend_mean(a, a, a).collect()} == {1.0}
    with pytest.raises(Exception, match="not once in every"):
        blend_mean(a, a.union(a.limit(1)), a.offset(1)).collect()


def test_tensors_are_not_sorted_to_be_written(spark, tmp_path):
    rows = spark.range(60).select(F.lit("a").alias("s"), F.col("id").alias("pos"), F.col("id").alias("t"), F.col("id").cast("double").alias("m"))
    wins = sliding_windows(rows, ["s"], "pos", "t", ["m"], 4, "m", "m").withColumn("split", F.when(F.col("target_pos") % 3 > 0, "train").otherwise("val"))
    seen, name = [], next(iter(files.OPEN_FILES))
    before = spark.conf.get(name, None)

    class Recorded:
        sparkSession = spark

        @property
        def write(self):
            seen.append(spark.conf.get(name))
            return wins.write

    files.write_windows(Recorded(), str(tmp_path / "w"))
    assert seen == ["4"] and spark.conf.get(name, None) == before
    back = files.read_windows(spark, str(tmp_path / "w"))
    key = ["target_pos", "x", "y_raw", "split"]
    assert sorted(map(tuple, back.select(key).collect())) == sorted(map(tuple, wins.select(key).collect()))


def test_the_word_table_keeps_what_a_task_meets_again():
    import public_tokenizers

    encoder = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [" ".join(f"w{'abcdefghij'[i % 10]}{chr(97 + i // 10 % 26)}{chr(97 + i // 260 % 26)}{chr(97 + i // 6760 % 26)}{part}" for i in range(50_000))
             for part in "xyzv"]
    first = [encoder.ids([t])[0].tolist() for t in texts]
    learned, encoder._learn = encoder._learn, None  # nothing may be new
    assert [encoder.ids([t])[0].tolist() for t in texts] == first
    assert learned
