import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shiftloom.operators import intervals as ops
from shiftloom.schemas import schema_of

START = datetime(2026, 2, 12, 7)


def interval(line, t, seq, status, **values):
    base = dict.fromkeys(schema_of("intervals").names)
    base |= {"ProductionLineId": line, "IntervalBegin": t, "CreatedAt": t, "IntervalSeq": seq}
    base |= {"IntervalProductionLineStatus": status, "TimeSinceLastWorkshiftBegin": "06:04:00"}
    return tuple((base | values).values())


def frame(spark, rows):
    return spark.createDataFrame(rows, schema_of("intervals"))


def lines(spark):
    return spark.createDataFrame([(1, "Línea Uno"), (2, "Línea Dos")], schema_of("lines"))


def begun(statuses, code):
    clean = [s.strip() for s in statuses]
    return sum(s == code and (i == 0 or clean[i - 1] != code) for i, s in enumerate(clean))


def test_recorded_snapshot(spark):
    t = datetime(2026, 2, 12, 13, 3)
    row = interval(
        1, t, 1, "AV", OEE=71.8341, OEEAvailability=67.3015, OEEPerformance=106.7251, OEEQuality=100.0,
        TimeSinceLastStatusChange="364", EffectiveAvailableTime="03:32:00", ScheduledStopageTime="00:49:59",
        UnscheduledStopageTime="01:43:00", CurrentRate=1084.8, ExpectedRate=1492.0, CurrentShiftProduction=5626.336,
        ExpectedShiftProduction=5271.804, CurrentProduction=4686.336, ExpectedDayProduction=5776.56,
    )
    out = ops.snapshots(frame(spark, [row]), lines(spark)).first()
    assert (out.OEE, out.Availability, out.Performance, out["Producto Conforme"]) == (71.83, 67.3, 106.73, 100.0)
    assert (out.NaturalTimeMin, out.ProductiveTimeMin, out.ScheduledStopageMin, out.UnscheduledStopageMin) == (364, 212, 49, 103)
    assert (out.StatusTimeMin, out.StatusCode, out.LineName) == (64, "Disponible", "Línea Uno")
    outlook = ops.day_target_outlook(ops.snapshots(frame(spark, [row]), lines(spark))).first()
    assert round(outlook.gap_kg, 3) == 1090.224 and round(outlook.hours_needed, 3) == 1.005 and outlook.target_met is False


def test_newest_breaks_ties_by_creation(spark):
    rows = [
        interval(1, START, 1, "AV", CreatedAt=START + timedelta(seconds=5)),
        interval(2, START, 2, "LP", CreatedAt=START),
        interval(2, START - timedelta(hours=1), 3, "US"),
    ]
    assert ops.newest(frame(spark, rows)).first().ProductionLineId == 1
    out = ops.newest_per_line(frame(spark, rows)).orderBy("ProductionLineId").collect()
    assert [(r.ProductionLineId, r.IntervalSeq) for r in out] == [(1, 1), (2, 2)]


def test_line_pattern(spark):
    rows = [interval(1, START, 1, "AV"), interval(2, START, 2, "AV")]
    out = ops.snapshots(frame(spark, rows), lines(spark), "DOS").collect()
    assert [r.LineName for r in out] == ["Línea Dos"]


def test_lookback_includes_both_ends(spark):
    t = START + timedelta(hours=2)
    steps = [(-61, "US"), (-60, "US"), (-30, "AV"), (-10, " US"), (-5, "SS"), (0, "US")]
    rows = [interval(1, t + timedelta(minutes=m), i, s, TimeSinceLastWorkshiftBegin="00:10:00") for i, (m, s) in enumerate(steps)]
    hour = ops.snapshots(frame(spark, rows), lines(spark), shift=False).first()
    assert (hour.ParosNoProgramadosCont, hour.ParosProgramadosCont) == (3, 1)
    shift = ops.snapshots(frame(spark, rows), lines(spark)).first()
    assert (shift.ParosNoProgramadosCont, shift.ParosProgramadosCont) == (2, 1)


@pytest.mark.parametrize("seed", range(3))
def test_execution_counts_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for seq in range(600):
        line = 1 if rng.random() < 0.5 else 2
        t = START + timedelta(minutes=rng.randrange(0, 60 * 72))
        rows.append((line, t, seq, rng.choice(["US", " US", "SS", "AV", "LP"])))
    spans = []
    for number in range(8):
        begin = START + timedelta(hours=8 * number, minutes=rng.randrange(60))
        spans.append((number, begin, begin + timedelta(hours=8) if number != 5 else None))
    shifts = spark.createDataFrame(
        [(n, line, a, b) for n, a, b in spans for line in (1, 2, 3)],
        "WorkShiftExecutionId bigint, ProductionLineId bigint, StartDate timestamp_ntz, EndDate timestamp_ntz",
    )
    expected = {}
    for n, a, b in spans:
        for line in (1, 2, 3):
            inside = sorted((r[1], r[2], r[3]) for r in rows if r[0] == line and b is not None and a <= r[1] < b)
            codes = [r[2] for r in inside]
            expected[n, line] = (begun(codes, "US"), begun(codes, "SS"))
    out = ops.with_counts(shifts, frame(spark, [interval(*r) for r in rows])).collect()
    got = {(r.WorkShiftExecutionId, r.ProductionLineId): (r.ParosNoProgramadosCont, r.ParosProgramadosCont) for r in out}
    assert got == expected
    reach = shifts.where("WorkShiftExecutionId > 2")
    within = ops.with_counts(reach, frame(spark, [interval(*r) for r in rows]), executions=reach).collect()
    got = {(r.WorkShiftExecutionId, r.ProductionLineId): (r.ParosNoProgramadosCont, r.ParosProgramadosCont) for r in within}
    assert got == {k: v for k, v in expected.items() if k[0] > 2}


def test_clock_offset(spark):
    rows = frame(spark, [interval(1, START, 0, "US")])
    shift = spark.createDataFrame(
        [(1, 1, START + timedelta(hours=6), START + timedelta(hours=14))],
        "WorkShiftExecutionId bigint, ProductionLineId bigint, StartDate timestamp_ntz, EndDate timestamp_ntz",
    )
    assert ops.with_counts(shift, rows).first().ParosNoProgramadosCont == 0
    assert ops.with_counts(shift, rows, offset_hours=6).first().ParosNoProgramadosCont == 1


def test_synced_and_metrics(spark):
    row = interval(1, START, 1, "US", TimeSinceLastStatusChange="00:05:00", EffectiveAvailableTime="01:00:00")
    totals = spark.createDataFrame([(3, 61.0, 0, 0.0)], "np_events bigint, np_minutes double, p_events bigint, p_minutes double")
    out = ops.synced(ops.snapshots(frame(spark, [row]), lines(spark)), totals)
    first = out.first()
    assert (first.ParosNoProgramadosCont, first.UnscheduledStopageMin) == (3, "1 hora y 1 minuto")
    assert (first.ParosProgramadosCont, first.ScheduledStopageMin, first.StatusTimeMin) == (0, "0 minutos", "5 minutos")
    metrics = {r["Métrica"]: r["Valor"] for r in ops.snapshot_metrics(out).collect()}
    assert len(metrics) == 15 and metrics["Estatus Actual"] == "Paro No Programado" and metrics["Paros No Programados (Eventos)"] == "3"


def test_status_stops_end_at_the_next_row(spark):
    steps = [(0, "US"), (5, "US"), (200, "AV"), (201, "SS")]
    rows = [interval(1, START + timedelta(minutes=m), i, s) for i, (m, s) in enumerate(steps)]
    out = ops.status_stops(frame(spark, rows)).orderBy("StartDate").collect()
    assert [((r.EndDate - r.StartDate).seconds // 60, r.Type) for r in out] == [(5, "NP"), (195, "NP")]
    assert ops.status_stops(frame(spark, rows)).where(F.col("Type") == "P").count() == 0
