import pytest
from pyspark.sql import functions as F

from shiftloom.functions import numbers, texts, times


@pytest.mark.parametrize(
    "minutes, text",
    [
        (1500.0, "1 día y 1 hora"),
        (1440.0, "1 día"),
        (2941.0, "2 días, 1 hora y 1 minuto"),
        (61.0, "1 hora y 1 minuto"),
        (59.6, "1 hora"),
        (0.4, "0 minutos"),
        (0.0, "0 minutos"),
        (-5.0, "0 minutos"),
        (None, "0 minutos"),
        (2.5, "2 minutos"),
    ],
)
def test_format_duration(one, minutes, text):
    assert one(lambda c: times.format_duration(F.col(c)), minutes, "double") == text


def test_format_duration_english(one):
    assert one(lambda c: times.format_duration(F.col(c), "en"), 1561.0, "double") == "1 day, 2 hours and 1 minute"


@pytest.mark.parametrize(
    "text, minutes", [("01:02:03", 62), ("364", 64), ("x", None), ("23:59", 1439), ("24:00", 0), ("7", 7), (None, None)]
)
def test_parse_duration_text(one, text, minutes):
    assert one(lambda c: times.parse_duration_text(F.col(c)), text) == minutes


@pytest.mark.parametrize(
    "text, day",
    [
        (" 2026-01-06 ", "2026-01-06"),
        ("01/06/2026", "2026-06-01"),
        ("1/6/2026", "2026-06-01"),
        ("6 Jan 2026", "2026-01-06"),
        ("6 January 2026", "2026-01-06"),
        ("20260106", "2026-01-06"),
        ("2026/01/06", "2026-01-06"),
        ("2026-1-6", "2026-01-06"),
        ("06/01/26", "2026-01-06"),
        ("6.1.26", "2026-01-06"),
        ("Jan 6 2026", "2026-01-06"),
        ("06.01.2026 10:00", "2026-01-06"),
        ("2026-01-06T10:11", "2026-01-06"),
        ("2026-01-06 10:11:12", "2026-01-06"),
        ("99/99/2026", "2026-99-99"),
        ("mañana", "mañana"),
        ("2026/13/45", "2026/13/45"),
        ("", ""),
        (None, ""),
    ],
)
def test_parse_day(one, text, day):
    assert one(lambda c: times.parse_day(F.col(c)), text) == day


def test_seconds_between_counts_boundaries(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ '2024-01-01 00:00:00.9' AS a, TIMESTAMP_NTZ '2024-01-01 00:00:01.1' AS b, "
        "CAST(NULL AS TIMESTAMP_NTZ) AS n, TIMESTAMP_NTZ '2024-03-01 00:00:00' AS m"
    )
    row = df.select(
        times.seconds_between(F.col("a"), F.col("b")).alias("x"),
        times.seconds_between(F.col("a"), F.col("n")).alias("y"),
        times.seconds_between(F.col("b"), F.col("m")).alias("z"),
    ).first()
    assert (row.x, row.y, row.z) == (1, None, 60 * 86400 - 1)


def test_int_avg_truncates(spark):
    row = spark.sql("SELECT 7L AS s, 2L AS n, 0L AS z").select(
        times.int_avg(F.col("s"), F.col("n")).alias("a"), times.int_avg(F.col("s"), F.col("z")).alias("b")
    ).first()
    assert (row.a, row.b) == (3, None)


@pytest.mark.parametrize("value, sql, py", [(0.5, 1.0, 0.0), (1.5, 2.0, 2.0), (2.5, 3.0, 2.0), (-0.5, -1.0, 0.0)])
def test_rounding_families(one, value, sql, py):
    assert one(lambda c: numbers.round_sql(F.col(c), 0), value, "double") == sql
    assert one(lambda c: numbers.round_py(F.col(c), 0), value, "double") == py


def test_divide_family(spark):
    row = spark.sql("SELECT 6D AS n, 0D AS z, -2D AS m").select(
        numbers.divide_or_null(F.col("n"), F.col("z")).alias("a"),
        numbers.divide_or(F.col("n"), F.col("z"), 0.0).alias("b"),
        numbers.divide_zero_as_one(F.col("n"), F.col("z")).alias("c"),
        numbers.divide_zero_as_one(F.col("n"), F.col("m")).alias("d"),
        numbers.divide_positive_or_one(F.col("n"), F.col("m")).alias("e"),
    ).first()
    assert tuple(row) == (None, 0.0, 6.0, -3.0, 6.0)


def test_number_texts(one):
    assert one(lambda c: numbers.fixed(F.col(c), 1, "%"), 1234.56, "double") == "1234.6%"
    assert one(lambda c: numbers.grouped(F.col(c)), 1234567.4, "double") == "1,234,567"
    assert one(lambda c: numbers.events_text(F.col(c)), 12.0, "double") == "12 ev."


@pytest.mark.parametrize("text, value", [("12.5", 12.5), ("abc", None), (None, None), (" 3 ", 3.0)])
def test_num_coerce(one, text, value):
    assert one(lambda c: numbers.num_coerce(F.col(c)), text) == value
    assert one(lambda c: numbers.num_coerce(F.col(c), 0.0), text) == (value or 0.0)


@pytest.mark.parametrize(
    "text, shift", [(" primer turno", "Primer"), ("SEGUNDO", "Segundo"), ("Tercero", "Tercer"), ("noche", None), (None, None)]
)
def test_normalize_shift(one, text, shift):
    assert one(lambda c: texts.normalize_shift(F.col(c)), text) == shift


def test_normalize_shift_strict(one):
    with pytest.raises(Exception, match="unknown shift"):
        one(lambda c: texts.normalize_shift(F.col(c), strict=True), "noche")


@pytest.mark.parametrize(
    "name, english",
    [
        ("Presión Diferencial", "Differential Pressure"),
        ("  iqf ", "IQF"),
        ("Temperatura interna IQF 2", "Internal Temperature IQF 2"),
        ("ALERTAS Detector de Metales", "Alerts Metal Detector"),
        ("Mezcladora", "Mezcladora"),
    ],
)
def test_translate_name(one, name, english):
    assert one(lambda c: texts.translate_name(F.col(c), "en"), name) == english
    assert one(lambda c: texts.translate_name(F.col(c)), name) == name


def test_slug_and_titles(one):
    assert one(lambda c: texts.slug(F.col(c)), " Línea / IQF-2 (A)! ") == "l_nea_iqf-2_a"
    assert one(lambda c: texts.clip_title(F.col(c)), "a\nb " + "x" * 60) == ("a b " + "x" * 60)[:47] + "..."
    assert one(lambda c: texts.clip_title(F.col(c)), "corto") == "corto"


def test_word_set_keeps_accents(one):
    assert sorted(one(lambda c: texts.word_set(F.col(c)), "Presión presión, agua_2!")) == ["agua_2", "presión"]


@pytest.mark.parametrize(
    "text, greeting, kpi, realtime, sql, bad",
    [
        ("Hola!", True, False, False, False, False),
        ("hola, ¿cuál es el OEE actual?", False, True, True, False, False),
        ("OEE actual del turno", False, True, False, False, False),
        ("select a from b", False, False, False, True, False),
        ("```SQL", False, False, False, True, False),
        ("No existe la tabla x", False, False, False, False, True),
    ],
)
def test_message_flags(one, text, greeting, kpi, realtime, sql, bad):
    flags = (texts.is_greeting, texts.asks_kpi, texts.asks_realtime, texts.looks_like_sql, texts.reports_bad_object)
    assert [one(lambda c, f=f: f(F.col(c)), text) for f in flags] == [greeting, kpi, realtime, sql, bad]


def test_speech_text_cuts_long_text(one):
    assert one(lambda c: texts.speech_text(F.col(c)), "**Hola**\n\n# mundo") == "Hola mundo"
    assert one(lambda c: texts.speech_text(F.col(c), 4000), "a" * 5000) == "a" * 4000 + "..."
    assert one(lambda c: texts.speech_text(F.col(c)), "a" * 5000) == "a" * 5000
