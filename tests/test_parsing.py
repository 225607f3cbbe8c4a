from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tripflow.functions import parsing as P
from tripflow.functions import quality as Q
from tripflow.functions import trips as C


def values(spark, texts, make):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", make(F.col("t")).alias("v")).orderBy("i").collect()]


def test_flex_int(spark):
    texts = ["12.9", " 7 ", "1e3", "-3", "-3.9", "abc", "", None, "1d", "0x1p3", "nan"]
    assert values(spark, texts, P.flex_int) == [12, 7, 1000, -3, -3] + [None] * 6


def test_to_num_keeps_infinity_and_drops_nan(spark):
    found = values(spark, ["inf", "-Infinity", "NaN", "1e400", ".5", "5.", "1f", "1_000"], P.to_num)
    assert found[0] == math.inf and found[1] == -math.inf and found[3] == math.inf
    assert found[2] is None and found[4:6] == [0.5, 5.0] and found[6:] == [None, None]


@pytest.mark.parametrize("text, expected", [
    ("2024-01-15T10:00:00Z", dt.datetime(2024, 1, 15, 10)),
    ("2024-01-15T10:00:00+05:30", dt.datetime(2024, 1, 15, 4, 30)),
    ("2024-01-15 10:00:00.25", dt.datetime(2024, 1, 15, 10, 0, 0, 250000)),
    ("2024-01-15T10:00:00,5", dt.datetime(2024, 1, 15, 10, 0, 0, 500000)),
    ("2024-01-15", dt.datetime(2024, 1, 15)),
    ("2024", None), ("x", None), ("", None), ("2024-02-30T00:00:00Z", None), ("10:00:00", None),
])
def test_iso_ts(spark, text, expected):
    assert values(spark, [text], P.iso_ts) == [expected]


@pytest.mark.parametrize("text, expected", [
    ("2013-06-01 00:00:01", dt.datetime(2013, 6, 1, 0, 0, 1)),
    ("6/1/2013 0:05:09", dt.datetime(2013, 6, 1, 0, 5, 9)),
    ("1/15/2015 9:07", dt.datetime(2015, 1, 15, 9, 7)),
    ("2015/1/15 09:07:00", dt.datetime(2015, 1, 15, 9, 7)),
    ("2024-01-15T10:00:00-05:00", dt.datetime(2024, 1, 15, 15)),
    ("2024-1-5 1:02:03", dt.datetime(2024, 1, 5, 1, 2, 3)),
    ("bad time", None), ("2024-01", None), ("", None),
])
def test_to_ts(spark, text, expected):
    assert values(spark, [text], P.to_ts) == [expected]


def test_offset_is_seen_only_behind_a_time(spark):
    texts = ["2024-01-15T10:00:00Z", "2024-01-15T10:00:00-05", "2024-01-15T10:00:00", "2024-01-15"]
    assert values(spark, texts, P.has_offset) == [True, True, False, False]


def test_ride_key_vector(spark):
    df = spark.sql("""SELECT 'a.parquet' f, TIMESTAMP_NTZ'2024-01-15 10:00:00.7' s,
        TIMESTAMP_NTZ'2024-01-15 10:30:00' e, CAST(NULL AS STRING) b""")
    key = df.select(C.ride_key(*[F.col(c) for c in "fseb"])).first()[0]
    assert key == "9f2bd37c0cd061b9fd06df2914cf0c87"


def test_birth_year_bounds(spark):
    df = spark.createDataFrame([(1899.0,), (1900.0,), (2026.0,), (2027.0,), (1950.5,), (None,)],
                               "n double")
    clean = [r[0] for r in df.select(C.clean_birth_year(F.col("n"), 2026)).collect()]
    load = [r[0] for r in df.select(C.load_birth_year(F.col("n"), 2026)).collect()]
    assert clean == [None, 1900, 2026, None, None, None]
    assert load == [0, 1900, 2026, 0, 0, 0]


def test_durations_round_and_cut(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (CAST(NULL AS DOUBLE), TIMESTAMP_NTZ'2024-01-01 00:00:00', TIMESTAMP_NTZ'2024-01-01 00:00:02.5'),
        (CAST(NULL AS DOUBLE), TIMESTAMP_NTZ'2024-01-01 00:00:00', TIMESTAMP_NTZ'2024-01-01 00:00:03.5'),
        (7.9D, TIMESTAMP_NTZ'2024-01-01 00:00:00', TIMESTAMP_NTZ'2024-01-01 00:00:03.5') AS t(g, s, e)""")
    columns = [F.col(c) for c in "gse"]
    assert [r[0] for r in df.select(C.derive_duration_clean(*columns)).collect()] == [2.0, 4.0, 7.9]
    assert [r[0] for r in df.select(C.derive_duration_load(*columns)).collect()] == [2, 3, 7]


def test_quality_columns(spark):
    df = spark.createDataFrame([(s,) for s in (100, 90, 89, 75, 74, 60, 59, 0)], "s int")
    found = df.select(Q.quality_band(F.col("s")), Q.score_bucket(F.col("s"))).collect()
    assert [r[0] for r in found] == [
        "EXCELLENT", "EXCELLENT", "GOOD", "GOOD", "FAIR", "FAIR", "POOR", "POOR"]
    assert [r[1] for r in found] == [100, 90, 80, 70, 70, 60, 50, 0]


def test_station_and_member_defaults(spark):
    ids = values(spark, [" 12 ", "", "nan", None, "x"], C.clean_station_id)
    assert ids == ["12", None, None, None, "x"]
    df = spark.createDataFrame(
        [(None, "Subscriber"), (None, "CUSTOMER"), (None, "x"), ("", None), ("member", "Customer")],
        "m string, u string")
    clean = [r[0] for r in df.select(C.fill_member_clean(F.col("m"), F.col("u"))).collect()]
    load = [r[0] for r in df.select(C.fill_member_load(F.col("m"), F.col("u"))).collect()]
    assert clean == ["member", "casual", None, "", "member"]
    assert load == ["member", "casual", "unknown", "unknown", "member"]


def test_exact_average_rounds_half_up_once(spark):
    df = spark.createDataFrame([(41, 20), (0, 0)], "t long, n long")
    found = [r[0] for r in df.select(Q.exact_average(F.col("t"), F.col("n"), 10, 1)).collect()]
    assert [float(found[0]), found[1]] == [2.1, None]


def test_issues_and_display(spark):
    df = spark.sql("SELECT array('a', 'b') i, TIMESTAMP_NTZ'2024-03-04 05:06:07' p, true v")
    row = df.select(Q.issues_json(F.col("i")), Q.display_time(F.col("p")),
                    Q.status_label(F.col("v"))).first()
    assert tuple(row) == ('["a","b"]', "03/04 05:06:07", "Valid")
