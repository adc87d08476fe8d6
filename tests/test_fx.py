"""Base-currency conversion: golden cases and a comparison with ASOF joins."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from salesmart.operators import fx

D = dt.date
RATES_A1 = [
    (D(2024, 2, 19), 1.0, 14.20, 0.220, None),
    (D(2024, 2, 21), 1.0, 14.35, 0.221, None),
    (D(2024, 2, 23), 1.0, 14.50, 0.222, None),
    (D(2024, 2, 26), 1.0, 14.60, 0.223, None),
    (D(2024, 2, 27), 1.0, 14.70, 0.224, None),
    (D(2024, 2, 28), 1.0, 14.80, 0.225, None),
    (D(2024, 2, 29), 1.0, 14.90, 0.226, None),
]
RATE_SCHEMA = "date date, rub double, gel double, amd double, kgs double"
FACT_SCHEMA = "id int, d date, Currencies_Currency string, amount double"


def _convert(spark, rates, facts, date_from, date_to, **kw):
    r = spark.createDataFrame(rates, RATE_SCHEMA)
    f = spark.createDataFrame(facts, FACT_SCHEMA)
    params = fx.FxParams(**kw)
    out = fx.convert(spark, f, r, "d", ["amount"], date_from, date_to, params)
    return {row["id"]: row["amount_RUB"] for row in out.collect()}


def test_golden_lookups_and_products(spark):
    facts = [
        (1, D(2024, 2, 29), "RUB", 1.0),
        (2, D(2024, 2, 29), "GEL", 1.0),
        (3, D(2024, 2, 28), "AMD", 1.0),
        (4, D(2024, 2, 29), "gel", 1.0),
        (5, D(2024, 2, 24), "GEL", 1.0),
        (6, D(2024, 2, 25), "GEL", 1.0),
        (7, D(2024, 2, 22), "GEL", 1.0),
        (8, D(2024, 2, 10), "GEL", 1.0),
        (9, D(2024, 2, 29), "USD", 1.0),
        (10, D(2024, 2, 29), "GEL", 100.0),
        (11, D(2024, 2, 28), "AMD", 1000.0),
        (12, D(2024, 2, 29), "GEL", None),
        (13, D(2024, 2, 29), "  GEL  ", 100.0),
        (14, D(2024, 2, 29), "   ", 100.0),
        (15, D(2024, 2, 29), None, 5.0),
        (16, D(2024, 2, 29), "KGS", 5.0),
    ]
    # one chunk covering the window, as a single load of the reference
    got = _convert(spark, RATES_A1, facts, D(2024, 2, 10), D(2024, 2, 29), chunk_days=20)
    assert got[1] == 1.0
    assert got[2] == 14.90
    assert got[3] == 0.225
    assert got[4] == got[2]
    assert got[5] == 14.50 and got[6] == 14.50
    assert got[7] == 14.35
    assert got[8] is None
    assert got[9] is None
    assert got[10] == 1490.0
    assert got[11] == 225.0
    assert got[12] is None
    assert got[13] == 1490.0
    assert got[14] is None          # blank but not empty code: unknown currency
    assert got[15] == 5.0           # no code: base currency
    assert got[16] is None          # kgs column is null on that day


def test_no_rates_nulls_everything(spark):
    facts = [(1, D(2024, 2, 29), "RUB", 10.0), (2, D(2024, 2, 29), "GEL", 10.0)]
    got = _convert(spark, [], facts, D(2024, 2, 29), D(2024, 2, 29))
    assert got == {1: None, 2: None}
    got = _convert(spark, [], facts, D(2024, 2, 29), D(2024, 2, 29), null_when_no_rates=False)
    assert got[1] == 10.0 and got[2] is None


def test_single_old_rate_serves_later_days(spark):
    rates = [(D(2024, 1, 1), 1.0, 15.0, 0.25, None)]
    facts = [(1, D(2024, 3, 1), "GEL", 1.0), (2, D(2024, 1, 1), "GEL", 2.0)]
    got = _convert(spark, rates, facts, D(2024, 1, 1), D(2024, 3, 1), chunk_days=61)
    assert got == {1: 15.0, 2: 30.0}


def test_exact_day_with_null_rate_is_null(spark):
    rates = [(D(2024, 2, 28), 1.0, 14.80, 0.225, None), (D(2024, 2, 29), 1.0, None, 0.226, None)]
    facts = [(1, D(2024, 2, 29), "GEL", 1.0), (2, D(2024, 2, 29), "AMD", 1.0)]
    got = _convert(spark, rates, facts, D(2024, 2, 28), D(2024, 2, 29))
    assert got == {1: None, 2: 0.226}


def test_zero_and_large_amounts(spark):
    rates = [(D(2024, 2, 29), 1.0, 14.90, 0.226, None)]
    facts = [(1, D(2024, 2, 29), "GEL", 0.0), (2, D(2024, 2, 29), "GEL", 10_000_000.0)]
    got = _convert(spark, rates, facts, D(2024, 2, 29), D(2024, 2, 29))
    assert got[1] == 0.0
    assert got[2] == 149_000_000.0


def test_registered_currency(spark):
    rates = [(D(2024, 2, 29), 1.0, 14.90, 0.226, 0.5)]
    r = spark.createDataFrame(rates, RATE_SCHEMA).withColumn("usd", F.lit(90.0))
    f = spark.createDataFrame([(1, D(2024, 2, 29), "usd", 2.0)], FACT_SCHEMA)
    base = fx.FxParams()
    assert fx.convert(spark, f, r, "d", ["amount"], D(2024, 2, 29), D(2024, 2, 29), base).first()["amount_RUB"] is None
    ext = base.register_currency("usd", "USD")
    assert "USD" not in base.currency_columns          # no shared state mutated
    assert fx.convert(spark, f, r, "d", ["amount"], D(2024, 2, 29), D(2024, 2, 29), ext).first()["amount_RUB"] == 180.0


def _by_sql(rates, facts, lookback):
    """The rules of the conversion as DuckDB ASOF joins; facts are (id, day, code, amount, chunk from, chunk to)."""
    con = duckdb.connect()
    con.execute("CREATE TABLE r (day DATE, rub DOUBLE, gel DOUBLE, amd DOUBLE, kgs DOUBLE)")
    con.execute("CREATE TABLE f (id INT, day DATE, code VARCHAR, amount DOUBLE, cf DATE, ct DATE)")
    if rates:
        con.executemany("INSERT INTO r VALUES (?, ?, ?, ?, ?)", rates)
    con.executemany("INSERT INTO f VALUES (?, ?, ?, ?, ?, ?)", facts)
    return dict(con.execute(f"""
        WITH long AS (SELECT day, 'GEL' AS ccy, gel AS rate FROM r UNION ALL SELECT day, 'AMD', amd FROM r UNION ALL SELECT day, 'KGS', kgs FROM r),
        k AS (SELECT *, upper(trim(coalesce(nullif(code, ''), 'RUB'))) AS ccy, least(day, ct) AS upto FROM f),
        a AS (SELECT k.*, any_row.day AS seen FROM k ASOF LEFT JOIN (SELECT DISTINCT day FROM r) any_row ON any_row.day <= k.ct),
        e AS (SELECT a.*, own.day AS own_day, l.rate AS own_rate
              FROM a LEFT JOIN r own ON own.day = a.day AND a.day <= a.ct LEFT JOIN long l ON l.day = own.day AND l.ccy = a.ccy),
        w AS (SELECT e.*, known.day AS last_day, known.rate AS last_rate
              FROM e ASOF LEFT JOIN (SELECT * FROM long WHERE rate IS NOT NULL) known ON known.ccy = e.ccy AND known.day <= e.upto)
        SELECT id, CAST(CAST(round(CAST(CAST(amount AS VARCHAR) AS DECIMAL(24,6)) * CAST(CASE
                   WHEN seen IS NULL OR seen < cf - {lookback} THEN NULL WHEN ccy = 'RUB' THEN 1.0
                   WHEN own_day IS NOT NULL THEN own_rate WHEN last_day >= cf - {lookback} THEN last_rate END AS DECIMAL(12,6)), 4) AS VARCHAR) AS DOUBLE)
        FROM w""").fetchall())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    start = D(2023, 1, 1)
    rates = []
    for i in range(120):
        day = start + dt.timedelta(days=i)
        if rnd.random() < 0.35 or 50 <= i <= 70:
            continue
        pick = lambda lo, hi: None if rnd.random() < 0.15 else round(rnd.uniform(lo, hi), 3)
        rates.append((day, 1.0, pick(10, 20), pick(0.1, 0.3), pick(0.5, 1.5)))
    codes = ["RUB", "GEL", "amd", " KGS ", "USD", "", None, "  "]
    facts = []
    for i in range(600):
        day = start + dt.timedelta(days=rnd.randint(5, 119))
        amount = None if rnd.random() < 0.05 else round(rnd.uniform(0, 5000), 2)
        facts.append((i, day, rnd.choice(codes), amount))
    date_from, date_to = start + dt.timedelta(days=5), start + dt.timedelta(days=119)
    chunk_days = rnd.choice([1, 3, 7, 11])
    chunked = []
    for i, day, code, amount in facts:
        cf = date_from + dt.timedelta(days=(day - date_from).days // chunk_days * chunk_days)
        chunked.append((i, day, code, amount, cf, min(cf + dt.timedelta(days=chunk_days - 1), date_to)))
    got = _convert(spark, rates, facts, date_from, date_to, chunk_days=chunk_days)
    assert got == _by_sql(rates, chunked, 10)


@pytest.mark.parametrize("seed", [4, 5])
def test_chunks_off_the_grid_and_rows_past_them(spark, seed):
    """Each row brings its own chunk; some are dated past it, some past the window."""
    rnd = random.Random(seed)
    start, date_to = D(2023, 1, 1), D(2023, 3, 31)
    rates = [(start + dt.timedelta(days=i), 1.0, None if i % 5 == 0 else 14 + i / 100, 0.2, None if i % 3 else 0.9)
             for i in range(100) if rnd.random() < 0.6 and not 40 <= i <= 60]
    rows = []
    for i in range(400):
        cf = start + dt.timedelta(days=rnd.randint(0, 80))
        ct = min(cf + dt.timedelta(days=6), date_to)
        day = cf + dt.timedelta(days=rnd.randint(0, 9))
        rows.append((i, day, rnd.choice(["RUB", "GEL", "AMD", "KGS", "USD", ""]), rnd.choice([0.00004, 2e14, 12.34, None]), cf, ct))
    facts = spark.createDataFrame(rows, "id int, d date, Currencies_Currency string, amount double, cf date, ct date")
    out = fx.convert(spark, facts, spark.createDataFrame(rates, RATE_SCHEMA), "d", ["amount"], start, date_to, chunk_col="cf", chunk_end_col="ct")
    assert {r["id"]: r["amount_RUB"] for r in out.collect()} == _by_sql(rates, rows, 10)


def test_row_past_the_window_takes_the_latest_visible_rate(spark):
    rates = [(D(2024, 2, d), 1.0, float(d), 0.2, 1.0) for d in range(8, 16)]
    facts = [(1, D(2024, 2, 15), "RUB", 1.0), (2, D(2024, 2, 15), "GEL", 1.0)]
    assert _convert(spark, rates, facts, D(2024, 2, 8), D(2024, 2, 14)) == {1: 1.0, 2: 14.0}


def test_amounts_beyond_any_decimal_are_not_lost(spark):
    rates = [(D(2024, 2, 29), 1.0, 14.90, 0.226, None)]
    facts = [(1, D(2024, 2, 29), "RUB", 2e14), (2, D(2024, 2, 29), "GEL", 0.00004), (3, D(2024, 2, 29), "RUB", 1e25)]
    assert _convert(spark, rates, facts, D(2024, 2, 29), D(2024, 2, 29)) == {1: 2e14, 2: 0.0006, 3: 1e25}


def test_connection_currency_wins(spark):
    rates = [(D(2024, 2, 29), 1.0, 14.90, 0.226, None)]
    r = spark.createDataFrame(rates, RATE_SCHEMA)
    f = spark.createDataFrame([(1, D(2024, 2, 29), "AMD", 10.0, "GEL"), (2, D(2024, 2, 29), "AMD", 10.0, None),
                               (3, D(2024, 2, 29), "AMD", 10.0, "")],
                              "id int, d date, Currencies_Currency string, amount double, conn string")
    out = fx.convert(spark, f, r, "d", ["amount"], D(2024, 2, 29), D(2024, 2, 29), connection_currency="conn")
    got = {row["id"]: row["amount_RUB"] for row in out.collect()}
    assert got == {1: 149.0, 2: 2.26, 3: 2.26}


def test_chunk_days_must_be_positive(spark):
    with pytest.raises(ValueError):
        fx.window_chunks(spark, D(2024, 1, 1), D(2024, 1, 5), 0)
