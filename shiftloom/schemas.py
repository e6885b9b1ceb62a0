"""Schemas of the plant tables the operators read.

Times of day are ``HH:mm[:ss]`` text, clock times are ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SCHEMAS: dict[str, str] = {
    "templates": """
        WorkShiftTemplateId int, Name string, StartTime string, EndTime string, Active boolean""",
    "executions": """
        WorkShiftExecutionId bigint, WorkShiftTemplateId int, StartDate timestamp_ntz,
        EndDate timestamp_ntz, Status string, Active boolean, DayOff boolean""",
    "summaries": """
        WorkShiftExecutionId bigint, ProductionLineId bigint, Oee double, Availability double,
        Performance double, Quality double, UnscheduledStopagesCount int, ScheduledStopagesCount int,
        UnscheduledStopageMin double, ScheduledStopageMin double, WorkshiftDurationMin double,
        AvailableTimeMin double, ProductiveTimeMin double, ExpectedProductionSummary double,
        ExpectedProductionSummaryModified double, CurrentProductionSummary double,
        ConfiscationKg double, AvgExpectedVelocity double, AvgCurrentVelocity double, Active boolean""",
    "stopages": """
        MotiveId bigint, WorkShiftExecutionId bigint, StartDate timestamp_ntz, EndDate timestamp_ntz,
        Type string, Active boolean""",
    "motives": "MotiveId bigint, MotiveTypeId string, Name string, StoppageType string",
    "motive_types": "MotiveTypeId string, Name string",
    "intervals": """
        ProductionLineId bigint, IntervalBegin timestamp_ntz, CreatedAt timestamp_ntz, IntervalSeq bigint,
        OEE double, OEEAvailability double, OEEPerformance double, OEEQuality double,
        IntervalProductionLineStatus string, TimeSinceLastStatusChange string,
        TimeSinceLastWorkshiftBegin string, EffectiveAvailableTime string, ScheduledStopageTime string,
        UnscheduledStopageTime string, CurrentRate double, ExpectedRate double,
        CurrentShiftProduction double, ExpectedShiftProduction double, CurrentProduction double,
        ExpectedDayProduction double""",
    "lines": "ProductionLineId bigint, Name string",
    "catalog": """
        ProductionLineControlVariableId string, Name string, DeviceName string, Tag string,
        MinValue double, MaxValue double, CriticalMinValue double, CriticalMaxValue double,
        IsCritical boolean, Active boolean""",
    "reads": """
        ProductionLineControlVariableId string, ProductionLineId bigint, ReadSeq bigint,
        LocalTime timestamp_ntz, Value double, MinValue double, MaxValue double,
        CriticalMinValue double, CriticalMaxValue double, Day date, Shift string""",
    "threads": "thread_id string, user_name string, title string, created_at timestamp_ntz, active boolean",
    "messages": """
        thread_id string, turn bigint, role string, text string, images string, created_at timestamp_ntz""",
}


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast the columns of ``table``; extra columns are left out."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema_of(table).fields])
