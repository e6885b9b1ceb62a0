"""Plant tables as projections of the benchmark Parquet tables.

Every plant table is derived by Spark from the given tables, so all work grows
with them. Null, padded and unknown values are put in where the rules differ on
them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shiftloom.operators.conversations import titles
from shiftloom.operators.intervals import status_stops
from shiftloom.session import scratch_path
from shiftloom.sources.reads import write_reads

_WRITTEN: dict[tuple[str, str], str] = {}
_SCHEMAS: dict[str, StructType] = {}

# Shift id, name, start, end, active, start second, end second.
TEMPLATES = (
    (0, "Primer Turno", "07:00", "15:30", True, 25200, 55800),
    (1, "Segundo Turno", "15:30", "23:00", True, 55800, 82800),
    (2, "Tercer Turno", "23:00", "07:00", True, 82800, 111600),
)


# Fixed texts: second of the day, and seconds as ``HH:mm:ss``.
SECOND_OF_DAY = "(hour({0}) * 3600 + minute({0}) * 60 + second({0}))"
CLOCK = (
    "concat_ws(':', lpad(string({0} div 3600), 2, '0'), lpad(string({0} % 3600 div 60), 2, '0'),"
    " lpad(string({0} % 60), 2, '0'))"
)
EXEC_ID = "bigint(year({0}) * 10000 + month({0}) * 100 + day({0})) * 10 + {1}"
STARTS = f"array({', '.join(str(t[5]) for t in TEMPLATES)})"
ENDS = f"array({', '.join(str(t[6]) for t in TEMPLATES)})"
IDS = f"array({', '.join(str(t[0]) for t in TEMPLATES)})"


class Plant:
    """Lazily read plant tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, table: str) -> DataFrame:
        """A given table; its schema is read from the file footer once."""
        path = f"{self.folder}/{table}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def reads_path(self) -> str:
        """Folder of the reads, written by day and shift once per application."""
        key = (self.spark.sparkContext.applicationId, self.folder)
        if key not in _WRITTEN:
            _WRITTEN[key] = write_reads(self.reads(), scratch_path(self.spark, "reads"))
        return _WRITTEN[key]

    def templates(self) -> DataFrame:
        """Literal rows, whose exact size the planner knows."""
        rows = ", ".join(f"({t[0]}, '{t[1]}', '{t[2]}', '{t[3]}', {str(t[4]).lower()})" for t in TEMPLATES)
        return self.spark.sql(f"SELECT * FROM VALUES {rows} AS t(WorkShiftTemplateId, Name, StartTime, EndTime, Active)")

    def executions(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """Shift executions; a day range prunes the stored day, as a day partition would."""
        orders = self.raw("orders")
        if first is not None:
            orders = orders.where(f"o_orderdate >= DATE '{first}' AND o_orderdate < DATE '{last or first}' + 1")
        return orders.selectExpr(
            "o_orderkey AS WorkShiftExecutionId",
            "int(o_orderkey % 3) AS WorkShiftTemplateId",
            f"o_orderdate + INTERVAL '1' SECOND * {STARTS}[int(o_orderkey % 3)] AS StartDate",
            f"o_orderdate + INTERVAL '1' SECOND * {ENDS}[int(o_orderkey % 3)] AS EndDate",
            "CASE WHEN o_orderstatus = 'P' THEN 'open' ELSE 'closed' END AS Status",
            "o_orderkey % 50 <> 0 AS Active",
            "o_orderpriority = '5-LOW' AS DayOff",
        )

    def summaries(self) -> DataFrame:
        available, real = "l_quantity * 10", "l_extendedprice * (1 - l_discount)"
        return self.raw("lineitem").selectExpr(
            "l_orderkey AS WorkShiftExecutionId",
            "l_suppkey AS ProductionLineId",
            "100 * (1 - l_discount) * (1 - l_discount) * (1 - l_tax) AS Oee",
            "100 * (1 - l_discount) AS Availability",
            "100 * (1 - l_discount) AS Performance",
            "CASE WHEN l_linenumber = 6 THEN NULL WHEN l_tax = 0.08D THEN 0D ELSE 100 * (1 - l_tax) END AS Quality",
            "CASE WHEN l_linenumber <> 4 THEN l_linenumber END AS UnscheduledStopagesCount",
            "CASE WHEN l_returnflag <> 'A' THEN l_linenumber % 3 END AS ScheduledStopagesCount",
            f"CASE WHEN l_linenumber <> 3 THEN {available} - {available} * (1 - l_discount) END AS UnscheduledStopageMin",
            "l_linenumber * 5D AS ScheduledStopageMin",
            f"{available} + l_linenumber * 5D AS WorkshiftDurationMin",
            f"{available} AS AvailableTimeMin",
            f"{available} * (1 - l_discount) AS ProductiveTimeMin",
            "l_extendedprice * 1.1D AS ExpectedProductionSummary",
            "l_extendedprice AS ExpectedProductionSummaryModified",
            f"{real} AS CurrentProductionSummary",
            f"CASE WHEN l_linenumber <> 5 THEN {real} * l_tax END AS ConfiscationKg",
            f"l_extendedprice / ({available} / 60D) AS AvgExpectedVelocity",
            f"{real} / ({available} / 60D) AS AvgCurrentVelocity",
            "l_linenumber <> 7 AS Active",
        )

    def stopages(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            "l_partkey AS MotiveId",
            "l_orderkey AS WorkShiftExecutionId",
            "l_shipdate AS StartDate",
            "CASE WHEN l_linenumber <> 2 OR l_discount <> 0 THEN"
            " l_shipdate + INTERVAL '1' SECOND * (int(l_quantity) * 60 + l_linenumber * 7) END AS EndDate",
            "CASE WHEN l_returnflag = 'N' THEN 'P' ELSE 'NP' END AS Type",
            "l_linestatus = 'F' AS Active",
        )

    def motives(self) -> DataFrame:
        return self.raw("part").where("p_size > 5").selectExpr(
            "p_partkey AS MotiveId",
            "p_brand AS MotiveTypeId",
            "p_name AS Name",
            "CASE WHEN p_size <= 25 THEN 'NP' WHEN p_size <= 40 THEN 'P' END AS StoppageType",
        )

    def motive_types(self) -> DataFrame:
        brands = self.raw("part").where("p_brand <> 'Brand#1'").select("p_brand").distinct()
        return brands.selectExpr("p_brand AS MotiveTypeId", "'TIPO ' || p_brand AS Name")

    def intervals(self) -> DataFrame:
        code = """CASE WHEN event_id % 97 = 0 THEN 'MT' WHEN event_type = 'error' AND event_id % 7 = 0 THEN ' US'
            WHEN event_type = 'error' THEN 'US' WHEN event_type = 'signup' THEN 'SS' WHEN event_type = 'click' THEN 'LP'
            ELSE 'AV' END"""
        clocked = self.raw("events").selectExpr("*", f"{SECOND_OF_DAY.format('ts')} AS sod").selectExpr(
            "*",
            """CASE WHEN sod >= 82800 THEN sod - 82800 WHEN sod >= 55800 THEN sod - 55800
                WHEN sod >= 25200 THEN sod - 25200 ELSE sod + 3600 END AS since""",
            "50 + value / 10 AS a",
            "double(60 + event_id % 50) AS p",
            "double(100 - event_id % 6) AS q",
        )
        return clocked.selectExpr(
            "user_id AS ProductionLineId",
            "ts AS IntervalBegin",
            "ts + INTERVAL '30' SECOND AS CreatedAt",
            "event_id AS IntervalSeq",
            "a * p * q / 10000 AS OEE",
            "a AS OEEAvailability",
            "p AS OEEPerformance",
            "q AS OEEQuality",
            f"{code} AS IntervalProductionLineStatus",
            f"CASE WHEN event_id % 5 = 0 THEN string(event_id % 1000) ELSE {CLOCK.format('(event_id * 61 % 86400)')} END"
            " AS TimeSinceLastStatusChange",
            f"{CLOCK.format('since')} AS TimeSinceLastWorkshiftBegin",
            f"{CLOCK.format('(since div 2)')} AS EffectiveAvailableTime",
            f"{CLOCK.format('(since div 8)')} AS ScheduledStopageTime",
            f"{CLOCK.format('(since div 4)')} AS UnscheduledStopageTime",
            "CASE WHEN event_id % 11 = 0 THEN 0D ELSE value * 3 END AS CurrentRate",
            "double(500 + event_id % 100) AS ExpectedRate",
            "value * 10 AS CurrentShiftProduction",
            "value * 9 + 5 AS ExpectedShiftProduction",
            "value * 20 AS CurrentProduction",
            "double(4000 + event_id % 500) AS ExpectedDayProduction",
        )

    def lines(self) -> DataFrame:
        ids = self.raw("events").select("user_id").distinct()
        return ids.selectExpr("user_id AS ProductionLineId", "'Linea ' || user_id AS Name")

    def plant_executions(self) -> DataFrame:
        """Three shifts for each day that has events."""
        days = self.raw("events").selectExpr("date(ts) AS day").distinct()
        return days.selectExpr("day", f"explode({IDS}) AS tid").selectExpr(
            f"{EXEC_ID.format('day', 'tid')} AS WorkShiftExecutionId",
            "tid AS WorkShiftTemplateId",
            f"CAST(day AS TIMESTAMP_NTZ) + INTERVAL '1' SECOND * {STARTS}[tid] AS StartDate",
            f"CAST(day AS TIMESTAMP_NTZ) + INTERVAL '1' SECOND * {ENDS}[tid] AS EndDate",
            "'closed' AS Status",
            "true AS Active",
            "day(day) % 7 = 0 AS DayOff",
        )

    def plant_summaries(self) -> DataFrame:
        """A summary for each line, day with events, and shift."""
        per_day = (
            self.raw("events")
            .groupBy(F.col("user_id").alias("ProductionLineId"), F.to_date("ts").alias("day"))
            .agg(F.expr("double(count(*)) AS n"), F.expr("double(sum(CAST(value AS DECIMAL(18,2)))) AS v"))
        )
        rows = per_day.selectExpr("*", f"explode({IDS}) AS tid")
        return rows.selectExpr(
            f"{EXEC_ID.format('day', 'tid')} AS WorkShiftExecutionId",
            "ProductionLineId",
            "(50 + n) * double(80 + tid) * double(100 - tid) / 10000 AS Oee",
            "50 + n AS Availability",
            "double(80 + tid) AS Performance",
            "double(100 - tid) AS Quality",
            "0 AS UnscheduledStopagesCount",
            "0 AS ScheduledStopagesCount",
            "n * 3 AS UnscheduledStopageMin",
            "30D AS ScheduledStopageMin",
            "480D AS WorkshiftDurationMin",
            "450D AS AvailableTimeMin",
            "450 - n * 3 AS ProductiveTimeMin",
            "v * 1.2D AS ExpectedProductionSummary",
            "v * 1.2D AS ExpectedProductionSummaryModified",
            "v AS CurrentProductionSummary",
            "0D AS ConfiscationKg",
            "v * 1.2D / 8 AS AvgExpectedVelocity",
            "v / 8 AS AvgCurrentVelocity",
            "true AS Active",
        )

    def interval_stops(self) -> DataFrame:
        return status_stops(self.intervals())

    def plant_stopages(self) -> DataFrame:
        """Stops read off the intervals, booked on the shift of their day in which they begin."""
        tid = "CASE WHEN sod BETWEEN 25200 AND 55799 THEN 0 WHEN sod BETWEEN 55800 AND 82799 THEN 1 ELSE 2 END"
        timed = self.interval_stops().selectExpr(
            "*", f"{SECOND_OF_DAY.format('StartDate')} AS sod", "date(StartDate - INTERVAL '7' HOUR) AS day"
        )
        return timed.selectExpr(
            "ProductionLineId AS MotiveId",
            f"{EXEC_ID.format('day', tid)} AS WorkShiftExecutionId",
            "StartDate",
            "EndDate",
            "Type",
            "true AS Active",
        )

    def catalog(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "'Var-' || p_partkey AS ProductionLineControlVariableId",
            "CASE WHEN p_size <> 50 THEN p_name END AS Name",
            "p_type AS DeviceName",
            "CASE WHEN p_size <> 49 THEN p_brand END AS Tag",
            "CASE WHEN p_size % 10 <> 0 THEN p_size / 10D END AS MinValue",
            "50 + p_size * 2D AS MaxValue",
            "5D AS CriticalMinValue",
            "100 + p_size * 1D AS CriticalMaxValue",
            "p_partkey % 3 <> 0 AS IsCritical",
            "p_size > 5 AS Active",
        )

    def reads(self) -> DataFrame:
        return self.raw("events").selectExpr("*", f"{SECOND_OF_DAY.format('ts')} AS sod").selectExpr(
            "'Var-' || ((user_id + event_id % 2) % 12) AS ProductionLineControlVariableId",
            "user_id AS ProductionLineId",
            "event_id AS ReadSeq",
            "ts AS LocalTime",
            "CASE WHEN event_id % 37 <> 0 THEN value END AS Value",
            "0D AS MinValue",
            "400D AS MaxValue",
            "double(5 + event_id % 3) AS CriticalMinValue",
            "double(100 + 10 * (event_id % 3)) AS CriticalMaxValue",
            "date(ts - INTERVAL '7' HOUR) AS Day",
            "CASE WHEN sod BETWEEN 25200 AND 55799 THEN 'Primer' WHEN sod BETWEEN 55800 AND 82799 THEN 'Segundo'"
            " ELSE 'Tercer' END AS Shift",
        )

    def messages(self) -> DataFrame:
        return self.raw("conversations").selectExpr(
            "'thread_' || conv_id AS thread_id",
            "turn",
            "role",
            "text",
            """CASE WHEN role = 'assistant'
                THEN '["static/plots/p_' || conv_id || '.html", "static/plots/q_' || turn || '.png"]'
                WHEN turn % 4 = 0 THEN '{bad' END AS images""",
            "TIMESTAMP_NTZ '2024-01-01 00:00:00' + INTERVAL '1' DAY * (conv_id % 60) + INTERVAL '1' MINUTE * turn AS created_at",
            "conv_id",
        )

    def user_name(self) -> Column:
        """User of a conversation, from its id."""
        return F.expr("'u' || (bigint(substring_index(thread_id, '_', -1)) % 5)")

    def threads(self) -> DataFrame:
        messages = self.messages()
        begun = messages.groupBy("thread_id").agg(F.min("created_at").alias("created_at"))
        return begun.join(titles(messages), "thread_id", "left").select(
            "thread_id",
            self.user_name().alias("user_name"),
            F.coalesce("title", F.lit("")).alias("title"),
            "created_at",
            F.expr("bigint(substring_index(thread_id, '_', -1)) % 7 <> 0 AS active"),
        )
