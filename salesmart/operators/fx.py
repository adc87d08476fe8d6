"""Base-currency conversion (JOIN-1, JOIN-2, OP-10, OP-11, EXT-1).

The as-of rules of the source loader are folded into one small dimension
table keyed by (currency, day) for the days of the load window:

1. RUB is 1.0; a code without a rate column has no rate.
2. A day that has a rate row uses that row's value, even when it is null.
3. Otherwise the latest earlier day with a non-null value is used, but only
   rate rows in ``[chunk_from - lookback, chunk_to]`` of the row's own request
   chunk are visible. A row dated past its chunk uses the latest visible rate.
4. A chunk that sees no rate row at all converts nothing, RUB included.

The table is built with a window (``last(..., ignorenulls)``) over the
calendar, so its size is currencies x days, known before the job runs. Which
rates a chunk sees is decided in the fact projection from the row's own chunk,
so chunks need no common grid. Facts need two equi-joins, on (currency, day)
and on the chunk's last day; both sides are sent to the tasks only when their
known size is below Spark's own broadcast limit.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.template import BASE_SUFFIX

BASE_CURRENCY = "RUB"

# Currency code -> column of the rate table.
DEFAULT_CURRENCY_COLUMNS = {"RUB": "rub", "GEL": "gel", "AMD": "amd", "KGS": "kgs"}

RATE_TYPE = "decimal(12,6)"
# wide enough for 18 digits before and 10 behind the point; the product is rounded once
AMOUNT_TYPE = "decimal(28,10)"
# upper bound of one row of the (currency, day) table, for the size check
RATE_ROW_BYTES = 100


@dataclass(frozen=True)
class FxParams:
    lookback_days: int = 10
    chunk_days: int = 7
    currency_columns: dict = field(default_factory=lambda: dict(DEFAULT_CURRENCY_COLUMNS))
    currency_field: str = "Currencies_Currency"
    # null every converted value of a chunk that sees no rates (RUB included)
    null_when_no_rates: bool = True

    def register_currency(self, code: str, column: str) -> "FxParams":
        """EXT-1: a new mapping without mutating shared state."""
        cols = dict(self.currency_columns)
        cols[code.strip().upper()] = column.lower()
        return FxParams(self.lookback_days, self.chunk_days, cols, self.currency_field, self.null_when_no_rates)


def base_pairs(measures: list[str], mart_columns: list[str]) -> list[tuple[str, str]]:
    """OP-12: (measure, base copy) pairs whose both columns exist in the mart."""
    from salesmart.functions.names import normalise_name
    pairs = []
    for m in measures:
        name = normalise_name(m)
        if name in mart_columns and name + BASE_SUFFIX in mart_columns:
            pairs.append((name, name + BASE_SUFFIX))
    return pairs


def effective_currency(row_currency: Column, connection_currency: Column | None = None) -> Column:
    """OP-11: connection currency, else the row's, else RUB; trimmed, upper-case.

    A blank but non-empty code stays blank and finds no rate.
    """
    parts = []
    if connection_currency is not None:
        parts.append(F.nullif(connection_currency, F.lit("")))
    parts.append(F.nullif(row_currency, F.lit("")))
    parts.append(F.lit(BASE_CURRENCY))
    return F.upper(F.trim(F.coalesce(*parts)))


def _stack_sql(rates_wide: DataFrame, currency_columns: dict) -> tuple[list[str], str]:
    """``stack`` arguments turning the wide rate row into (currency, rate) rows."""
    codes, parts = [], []
    for code, colname in currency_columns.items():
        if code != BASE_CURRENCY and colname in rates_wide.columns:
            codes.append(code)
            parts.append(f"'{code}', CAST(`{colname}` AS {RATE_TYPE})")
    if not parts:
        return [], f"stack(1, '', CAST(NULL AS {RATE_TYPE}))"
    return codes, f"stack({len(parts)}, {', '.join(parts)})"


def long_rates(rates_wide: DataFrame, currency_columns: dict) -> DataFrame:
    """Wide rate table -> (rate_date, currency, rate); null values are kept."""
    codes, stack = _stack_sql(rates_wide, currency_columns)
    out = rates_wide.selectExpr("date AS rate_date", f"{stack} AS (currency, rate)")
    return out if codes else out.where("false")


def window_chunks(spark: SparkSession, date_from: dt.date, date_to: dt.date, chunk_days: int) -> DataFrame:
    """WIN-2: inclusive chunks of ``chunk_days`` from ``date_from``; last one clipped."""
    if chunk_days < 1:
        raise ValueError("chunk_days must be at least 1")
    return spark.sql(f"""
        SELECT chunk_start, least(date_add(chunk_start, {chunk_days - 1}), DATE'{date_to}') AS chunk_end
        FROM (SELECT explode(sequence(DATE'{date_from}', DATE'{date_to}', INTERVAL {chunk_days} DAYS)) AS chunk_start)""")


def chunk_start_sql(day: str, date_from: dt.date, chunk_days: int) -> str:
    return (f"date_add(DATE'{date_from}', "
            f"CAST(floor(datediff({day}, DATE'{date_from}') / {chunk_days}) * {chunk_days} AS INT))")


def chunk_start_of(day: Column, date_from: dt.date, chunk_days: int) -> Column:
    """Chunk containing ``day`` for chunks anchored at ``date_from``."""
    offset = F.floor(F.datediff(day, F.lit(date_from)) / chunk_days) * chunk_days
    return F.date_add(F.lit(date_from), offset.cast("int"))


def _first_day(date_from: dt.date, params: FxParams) -> dt.date:
    # a landed chunk may start up to one chunk before the window
    return date_from - dt.timedelta(days=params.lookback_days + params.chunk_days)


def _rate_ctes(rates_wide: DataFrame, date_from: dt.date, date_to: dt.date, params: FxParams) -> str:
    lo = _first_day(date_from, params)
    codes, stack = _stack_sql(rates_wide, params.currency_columns)
    code_list = ", ".join(f"'{c}'" for c in codes or [""])
    frame = "ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    return f"""
    WITH visible AS (
      SELECT * FROM {{rates}} WHERE date >= DATE'{lo}' AND date <= DATE'{date_to}'),
    rate_rows AS (   -- duplicate rate days collapse to one row, larger rate wins
      SELECT currency, rate_date, max(rate) AS rate
      FROM (SELECT date AS rate_date, {stack} AS (currency, rate) FROM visible)
      GROUP BY currency, rate_date),
    row_days AS (SELECT DISTINCT date AS row_day FROM visible),
    grid AS (        -- one calendar per currency: currencies x (window + lookback) days
      SELECT currency, explode(sequence(DATE'{lo}', DATE'{date_to}')) AS day
      FROM (SELECT explode(array({code_list})) AS currency)),
    rates AS (
      SELECT g.currency, g.day, d.row_day IS NOT NULL AS has_row, r.rate AS exact_rate,
             last(r.rate, true) OVER (PARTITION BY g.currency {frame}) AS last_rate,
             last(CASE WHEN r.rate IS NOT NULL THEN g.day END, true) OVER (PARTITION BY g.currency {frame}) AS last_day
      FROM grid g
      LEFT JOIN rate_rows r ON g.currency = r.currency AND g.day = r.rate_date
      LEFT JOIN row_days d ON g.day = d.row_day),
    days AS (        -- latest day with a rate row; one task over the calendar's days, bounded by the window
      SELECT day, last(row_day, true) OVER ({frame}) AS last_row_day
      FROM (SELECT explode(sequence(DATE'{lo}', DATE'{date_to}')) AS day) c LEFT JOIN row_days d ON c.day = d.row_day)
    """


def rate_table(spark: SparkSession, rates_wide: DataFrame, date_from: dt.date, date_to: dt.date,
               params: FxParams = FxParams()) -> tuple[DataFrame, DataFrame]:
    """Rates by (currency, day) and the latest rate row by day, over the window and its lookback.

    Only rate rows of these days are read (the filter reaches the scan).
    """
    ctes = _rate_ctes(rates_wide, date_from, date_to, params)
    table = spark.sql(ctes + """
    SELECT currency AS _fx_currency, day AS _fx_day, has_row AS _fx_has_row, exact_rate AS _fx_exact,
           last_rate AS _fx_last, last_day AS _fx_last_day
    FROM rates WHERE currency <> ''""", rates=rates_wide)
    days = spark.sql(ctes + "SELECT day AS _fx_end, last_row_day AS _fx_row_day FROM days", rates=rates_wide)
    return table, days


def rate_table_rows(params: FxParams, date_from: dt.date, date_to: dt.date) -> int:
    """Exact row count of the (currency, day) table: the broadcast size check."""
    days = (date_to - _first_day(date_from, params)).days + 1
    return max(days, 0) * len([c for c in params.currency_columns if c != BASE_CURRENCY])


def _limit_bytes(spark: SparkSession) -> int:
    jconf = spark._jsparkSession.sessionState().conf()
    return int(jconf.autoBroadcastJoinThreshold())


def rated(spark: SparkSession, facts: DataFrame, rates_wide: DataFrame, date_field: str, date_from: dt.date,
          date_to: dt.date, params: FxParams = FxParams(), connection_currency: str | None = None,
          chunk_col: str | None = None, chunk_end_col: str | None = None) -> DataFrame:
    """The rows with ``_fx_rate``, the rate to the base currency (null: none is visible).

    ``chunk_col`` and ``chunk_end_col`` name the request chunk of each row when
    it is known from the landing (rows whose date did not parse still belong
    to a chunk); otherwise the chunk is the one of the window's grid that
    holds the row date, or the nearest one for a date outside the window.
    """
    if date_from > date_to:
        raise ValueError("empty load window")
    table, days = rate_table(spark, rates_wide, date_from, date_to, params)
    if rate_table_rows(params, date_from, date_to) * RATE_ROW_BYTES <= _limit_bytes(spark):
        table, days = F.broadcast(table), F.broadcast(days)
    q = lambda c: "`" + c.replace("`", "``") + "`"
    parts = ([f"nullif({q(connection_currency)}, '')"] if connection_currency else []) + \
        [f"nullif({q(params.currency_field)}, '')", f"'{BASE_CURRENCY}'"]
    day, last = q(date_field), f"DATE'{date_to}'"
    if chunk_col:
        start = q(chunk_col)
    else:
        inside = f"greatest(least({day}, {last}), DATE'{date_from}')"
        start = f"CASE WHEN {day} IS NOT NULL THEN {chunk_start_sql(inside, date_from, params.chunk_days)} END"
    keyed = facts.selectExpr("*", f"upper(trim(coalesce({', '.join(parts)}))) AS _fx_ccy", f"{start} AS _fx_from")
    end = q(chunk_end_col) if chunk_end_col else f"date_add(_fx_from, {params.chunk_days - 1})"
    keyed = keyed.selectExpr("*", f"CASE WHEN _fx_from IS NOT NULL THEN least({end}, {last}) END AS _fx_to")
    keyed = keyed.selectExpr("*", f"CASE WHEN {day} IS NOT NULL THEN least({day}, _fx_to) END AS _fx_key")
    joined = keyed.join(table, (keyed["_fx_ccy"] == table["_fx_currency"]) & (keyed["_fx_key"] == table["_fx_day"]), "left") \
        .join(days, keyed["_fx_to"] == days["_fx_end"], "left")
    seen = f"date_sub(_fx_from, {params.lookback_days})"
    gate = f"_fx_row_day >= {seen}" if params.null_when_no_rates else "true"
    rate = f"""CASE WHEN NOT coalesce({gate}, false) THEN CAST(NULL AS {RATE_TYPE})
        WHEN _fx_ccy = '{BASE_CURRENCY}' THEN CAST(1 AS {RATE_TYPE})
        WHEN _fx_has_row AND {day} <= _fx_to AND {day} >= {seen} THEN _fx_exact
        WHEN _fx_last_day >= {seen} THEN _fx_last END AS _fx_rate"""
    return joined.selectExpr(*[q(c) for c in facts.columns], rate)


def convert(spark: SparkSession, facts: DataFrame, rates_wide: DataFrame, date_field: str,
            measures: list[str], date_from: dt.date, date_to: dt.date,
            params: FxParams = FxParams(), connection_currency: str | None = None,
            chunk_col: str | None = None, chunk_end_col: str | None = None) -> DataFrame:
    """OP-10: add ``<m>_RUB = round(m * rate, 4)`` for every measure.

    Null amount or null rate gives null. Arithmetic is decimal at full
    precision and rounds once; an amount that no decimal holds (beyond 18
    digits, NaN) is multiplied as a double instead of being lost.
    ``connection_currency`` names a column with the source's fixed currency.
    """
    q = lambda c: "`" + c.replace("`", "``") + "`"
    rows = rated(spark, facts, rates_wide, date_field, date_from, date_to, params, connection_currency, chunk_col, chunk_end_col)
    converted = [
        f"coalesce(CAST(round(try_cast({q(m)} AS {AMOUNT_TYPE}) * _fx_rate, 4) AS DOUBLE), "
        f"round(CAST({q(m)} AS DOUBLE) * CAST(_fx_rate AS DOUBLE), 4)) AS {q(m + BASE_SUFFIX)}" for m in measures]
    return rows.selectExpr(*[q(c) for c in facts.columns], *converted)


def exact_rates(facts: DataFrame, rates_wide: DataFrame, date_field: str,
                params: FxParams = FxParams()) -> DataFrame:
    """JOIN-2: the rate of the row's own day only (rule 2 alone), left join.

    Duplicate rate days collapse to one row, the larger rate wins.
    """
    rate_rows = long_rates(rates_wide, params.currency_columns).groupBy("currency", "rate_date").agg(F.max("rate").alias("rate"))
    ccy = effective_currency(F.col(params.currency_field))
    keyed = facts.withColumn("_fx_ccy", ccy)
    joined = keyed.join(rate_rows, (keyed["_fx_ccy"] == rate_rows["currency"]) & (keyed[date_field] == rate_rows["rate_date"]), "left")
    rate = F.when(keyed["_fx_ccy"] == F.lit(BASE_CURRENCY), F.lit(1).cast(RATE_TYPE)).otherwise(rate_rows["rate"])
    return joined.select(*[keyed[c] for c in facts.columns], rate.cast("double").alias("rate"))
