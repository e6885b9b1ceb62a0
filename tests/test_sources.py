from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shiftloom.operators import sensors
from shiftloom.schemas import conform, schema_of
from shiftloom.session import scratch_path
from shiftloom.sources import reads as rd
from shiftloom.sources import sinks, tables
from shiftloom.streaming import live


def deliver(base, day, name, value):
    folder = base / day
    folder.mkdir(parents=True, exist_ok=True)
    table = pa.table(
        {
            "ProductionLineControlVariableId": ["AA"],
            "LocalTime": pa.array([datetime.fromisoformat(day + " 08:00:00")], pa.timestamp("us")),
            "Value": [value],
        }
    )
    pq.write_table(table, folder / name)


def test_delivered_files(spark, tmp_path):
    deliver(tmp_path, "2026-01-05", " Primer_Turno_b.parquet", 1.0)
    deliver(tmp_path, "2026-01-05", "x primer.parquet", 2.0)
    deliver(tmp_path, "2026-01-05", "segundo-1.parquet", 3.0)
    deliver(tmp_path, "2026-01-05", "otro.parquet", 4.0)
    deliver(tmp_path, "2026-01-07", "TERCER_9.parquet", 5.0)
    days = rd.days_between("2026-01-05", "2026-01-08", limit=14)
    out = rd.load_delivered(spark, str(tmp_path), days).orderBy("Value").collect()
    assert [(r.Value, r.Day, r.Shift) for r in out] == [
        (1.0, date(2026, 1, 5), "Primer"),
        (3.0, date(2026, 1, 5), "Segundo"),
        (5.0, date(2026, 1, 7), "Tercer"),
    ]
    assert [r.Value for r in rd.load_delivered(spark, str(tmp_path), days, ("Tercer",)).collect()] == [5.0]


def test_a_file_may_serve_several_shifts(spark, tmp_path):
    deliver(tmp_path, "2026-01-05", "primer_segundo.PARQUET", 1.0)
    out = rd.load_delivered(spark, str(tmp_path), ["2026-01-05"])
    assert sorted((r.Value, r.Shift) for r in out.collect()) == [(1.0, "Primer"), (1.0, "Segundo")]
    assert [r.Shift for r in rd.load_delivered(spark, str(tmp_path), ["2026-01-05"], ("Segundo",)).collect()] == ["Segundo"]


def test_nothing_delivered_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        rd.load_delivered(spark, str(tmp_path), ["2026-01-05"])
    deliver(tmp_path, "2026-01-05", "otro.parquet", 4.0)
    with pytest.raises(FileNotFoundError):
        rd.load_delivered(spark, str(tmp_path), ["2026-01-05"])


def test_range_limit():
    assert len(rd.days_between("2026-01-01", "2026-01-14", 14)) == 14
    with pytest.raises(ValueError):
        rd.days_between("2026-01-01", "2026-01-15", 14)


def test_written_reads_prune_partitions(spark, tmp_path):
    rows = [
        ("a", 1, i, datetime(2026, 1, 5 + i, 8), 1.0, None, None, None, None, date(2026, 1, 5 + i), shift)
        for i, shift in enumerate(("Primer", "Segundo", "Primer"))
    ]
    path = rd.write_reads(spark.createDataFrame(rows, schema_of("reads")), str(tmp_path / "reads"))
    out = rd.load_reads(spark, path, "2026-01-05", "2026-01-06", "Primer")
    assert [r.ReadSeq for r in out.collect()] == [0] and len(out.inputFiles()) >= 1
    plan = out._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(Day" in plan
    one = sensors.variable_reads(rd.load_reads(spark, path), " A ")
    assert one.count() == 3 and "EqualTo(SensorKey,A)" in one._jdf.queryExecution().toString()


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    df.write.parquet(str(tmp_path / "t"))
    out = tables.read_table(spark, str(tmp_path / "t"), ["b"], F.col("a") == 2)
    assert [tuple(r) for r in out.collect()] == [("y",)]
    df.createOrReplaceTempView("t_view")
    assert tables.read_table(spark, "t_view").count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_table(spark, str(tmp_path / "missing"))
    with pytest.raises(ValueError):
        tables.inline(spark, [], ["a"])
    assert tables.inline(spark, [[1, "x"]], ["n", "t"]).first().t == "x"


def test_csv_and_json(spark, tmp_path):
    df = spark.sql(
        "SELECT 'añ,o' AS a, TIMESTAMP_NTZ '2026-01-05 08:00:00.123456' AS t, CAST(1.50 AS DECIMAL(9,2)) AS d, "
        "CAST(NULL AS INT) AS n, CAST('ab' AS BINARY) AS b"
    )
    path = sinks.write_csv(df.drop("b"), str(tmp_path / "csv"))
    assert sinks.read_csv(spark, path, df.drop("b").schema).first() == df.drop("b").first()
    record = sinks.json_records(df).first().record
    assert record == '{"a":"añ,o","t":"2026-01-05 08:00:00.123456","d":"1.50","n":null,"b":"YWI="}'


class Settings:
    """A session that only knows its settings and its master."""

    def __init__(self, master="local[2]", **settings):
        self.conf = self.sparkContext = self
        self.master = master
        self.settings = settings

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_scratch_uses_the_shared_folder():
    named = Settings(**{"spark.checkpoint.dir": "hdfs://shared/ck/"})
    first, second = scratch_path(named, "x"), scratch_path(named, "x")
    assert first != second and first.startswith("hdfs://shared/ck/x-")
    assert "shiftloom-" in scratch_path(Settings(), "x")
    with pytest.raises(ValueError, match="checkpoint.dir"):
        scratch_path(Settings("spark://host:7077"), "x")


def test_bucketed_tables_join_without_shuffle(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    sinks.write_bucketed(df, "bucket_a", "k", 4)
    sinks.write_bucketed(df, "bucket_b", "k", 4)
    joined = spark.table("bucket_a").hint("merge").join(spark.table("bucket_b"), "k")
    assert joined.count() == 100
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE bucket_a")
    spark.sql("DROP TABLE bucket_b")


def test_conform(spark):
    df = spark.createDataFrame([("1", "Línea", 9)], "ProductionLineId string, Name string, more int")
    assert conform(df, "lines").first().asDict() == {"ProductionLineId": 1, "Name": "Línea"}


def test_live_newest_interval(spark, tmp_path):
    def arrive(rows):
        base = dict.fromkeys(schema_of("intervals").names)
        full = [
            tuple((base | {"ProductionLineId": line, "IntervalBegin": t, "CreatedAt": t, "IntervalSeq": seq}).values())
            for line, t, seq in rows
        ]
        spark.createDataFrame(full, schema_of("intervals")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        stream = live.stream_intervals(spark, str(tmp_path / "in"))
        live.start_newest(stream, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True).awaitTermination(120)
        rows = live.read_newest(spark, str(tmp_path / "out")).collect()
        return sorted((r.ProductionLineId, r.IntervalSeq) for r in rows)

    arrive([(1, datetime(2026, 1, 5, 8), 1), (2, datetime(2026, 1, 5, 9), 2)])
    assert run() == [(1, 1), (2, 2)]
    arrive([(1, datetime(2026, 1, 5, 10), 3), (2, datetime(2026, 1, 5, 7), 4)])
    assert run() == [(1, 3), (2, 2)]
