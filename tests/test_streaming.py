from __future__ import annotations

from pyspark.sql import functions as F

from replaystats.sources import tables as t
from replaystats.sources.tables import Tables
from replaystats.streaming.snapshots import daily_skill_stream, run_snapshot_stream
from tests.conftest import rows, times

SCHEMA = "user_id int, category string, skill float, start_time timestamp"


def write(spark, folder, data):
    df = times(spark.createDataFrame(data, "user_id int, category string, skill float, start_time string"), "start_time")
    df.coalesce(1).write.mode("append").parquet(str(folder))


def test_snapshot_stream(spark, tmp_path):
    source, tables = tmp_path / "source", Tables(spark, str(tmp_path / "tables"))

    def drain():
        stream = spark.readStream.schema(SCHEMA).parquet(str(source))
        run_snapshot_stream(stream, tables, str(tmp_path / "checkpoint")).awaitTermination()

    write(spark, source, [(1, "a", 5.0, "2025-01-01 10:00:00"), (1, "a", 5.0, "2025-01-01 10:00:00"), (None, "a", 1.0, "2025-01-01"), (2, None, 1.0, "2025-01-01")])
    drain()
    write(spark, source, [(1, "a", 7.0, "2025-01-01 10:00:00"), (1, "a", 6.0, "2025-01-02 10:00:00"), (2, "a", None, "2025-01-01")])
    drain()
    drain()
    assert rows(tables.read(t.SNAPSHOTS), "user_id", "skill") == [(1, 5.0), (1, 6.0), (2, None)]


def test_daily_skill_stream(spark, tmp_path):
    source = tmp_path / "source"
    write(spark, source, [(1, "a", 4.0, "2025-01-01 10:00:00"), (1, "a", 6.0, "2025-01-01 11:00:00"), (1, "a", 9.0, "2025-01-02 11:00:00")])
    write(spark, source, [(1, "a", 9.0, "2025-01-05 11:00:00")])
    stream = daily_skill_stream(spark.readStream.schema(SCHEMA).parquet(str(source)))
    out = str(tmp_path / "out")
    query = stream.writeStream.outputMode("append").format("parquet").option("path", out)
    query.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(out).withColumn("day", F.col("day").cast("string"))
    assert rows(got, "day", "avg_skill") == [("2025-01-01", 5.0), ("2025-01-02", 9.0)]  # the last day is still open
