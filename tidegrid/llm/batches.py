"""How much text a Python task gets at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame

BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
LIMITS = {BYTES: 8 << 20, ROWS: 2000}


def small_batches(df: DataFrame) -> DataFrame:
    """Lower the session's Arrow batches to 8 MB and 2000 rows, and give back ``df``.

    A batch of texts is held several times over on its way into Python, outside the
    executor's heap. The settings are read when a job runs, so they stay lowered.
    """
    conf = df.sparkSession.conf
    for setting, limit in LIMITS.items():
        now = conf.get(setting).lower().removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= limit:
            conf.set(setting, str(limit))
    return df
