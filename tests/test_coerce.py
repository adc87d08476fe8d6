"""Coercion of report text: literal cases and values written and read back."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salesmart.functions import coerce as C


def _run(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return {r["i"]: r["o"] for r in df.select("i", fn("v").alias("o")).collect()}


NAN = float("nan")
INF = float("inf")
# text -> number, as the source system reads it
NUMBERS = {"68 423,46": 68423.46, "1d": None, "abc": None, "": None, None: None, "1e5": 1e5, ".5": 0.5, "5.": 5.0, "+3": 3.0, "-2,5": -2.5, "1.2.3": None,
           "nan": NAN, "inf": INF, "Infinity": INF, "1 000 000": 1e6, "e5": None, "-": None, "12,5e-1": 1.25, "0x10": None, "true": 1.0, "false": 0.0,
           "1e": None, "--1": None, "1,2,3": None, " 7 ": 7.0, "1e+2": 100.0, "1_0": None, ".": None, ",": None}


def test_number_cases(spark):
    got = _run(spark, list(NUMBERS), C.to_number)
    for i, (text, want) in enumerate(NUMBERS.items()):
        assert got[i] == want or (want != want and got[i] != got[i]), text


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(0, 99)), min_size=1, max_size=40))
def test_written_amounts_read_back(spark, values):
    """Thousands with spaces and a decimal comma, as reports write them."""
    texts = [f"{whole:,}".replace(",", " ") + f",{cents:02d}" for whole, cents in values]
    got = _run(spark, texts, C.to_number)
    for i, (whole, cents) in enumerate(values):
        assert got[i] == float(f"{whole}.{cents:02d}")


def _t(*parts):
    return dt.datetime(*parts)


STAMPS = {"2024-01-05T10:00:00": _t(2024, 1, 5, 10), "2024-01-05T10:00:00.5": _t(2024, 1, 5, 10, 0, 0, 500000),
          "2024-01-05T10:00:00.123456": _t(2024, 1, 5, 10, 0, 0, 123456), "2024-01-05T10:00:00.1234567": None, "2024-01-05T10:00:00Z": None,
          "2024-1-5T1:2:3": _t(2024, 1, 5, 1, 2, 3), "2024-02-30T00:00:00": None, "2024-01-05": None, "2024-01-05T25:00:00": None,
          "2024-01-05T10:00": None, "": None, None: None, "2024-01-05T10:00:00.": None, "2024-01-05t10:00:00": _t(2024, 1, 5, 10),
          "0000-01-05T10:00:00": None, "2024-01-05T10:00:00 ": None, "2024-02-29T23:59:59.999999": _t(2024, 2, 29, 23, 59, 59, 999999)}


def test_timestamp_cases(spark):
    got = _run(spark, list(STAMPS), C.to_timestamp)
    for i, (text, want) in enumerate(STAMPS.items()):
        assert got[i] == want, text


DATES = {"2024-01-05": dt.date(2024, 1, 5), "2024-01-05T10:00:00": dt.date(2024, 1, 5), "2024-1-5": dt.date(2024, 1, 5), "29.02.2000": None,
         "2000-02-29": dt.date(2000, 2, 29), "2001-02-29": None, "2024-01-05 ": None, "": None, None: None, "2024-13-01": None, "20240105": None,
         "2024-01-05Tjunk": dt.date(2024, 1, 5), "T2024-01-05": None, "2024-01-05t10:00:00": None, "0000-01-01": None, "2024": None, "2024-01": None,
         " 2024-01-05": None, "99999-01-01": None}


def test_date_cases(spark):
    got = _run(spark, list(DATES), C.to_date)
    for i, (text, want) in enumerate(DATES.items()):
        assert got[i] == want, text


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.datetimes(dt.datetime(1000, 1, 1), dt.datetime(9999, 12, 31)), min_size=1, max_size=30))
def test_written_days_and_times_read_back(spark, values):
    texts = [v.isoformat() for v in values]
    dates, stamps = _run(spark, texts, C.to_date), _run(spark, texts, C.to_timestamp)
    for i, v in enumerate(values):
        assert dates[i] == v.date() and stamps[i] == v
