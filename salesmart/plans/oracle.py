"""DuckDB SQL for every registered query, over the same parquet views.

The derived inputs are rebuilt here with the arithmetic used by
``salesmart.sources.fixtures``; the operators are written the way a SQL
user would (correlated subqueries, CASE, EXISTS), independent of the
Spark formulation.
"""

from __future__ import annotations

CURRENCY_CASE = (
    "CASE l_suppkey % 6 WHEN 0 THEN 'RUB' WHEN 1 THEN 'GEL' WHEN 2 THEN 'amd' "
    "WHEN 3 THEN ' KGS ' WHEN 4 THEN 'USD' ELSE '' END"
)

SALES_RAW = f"""
SELECT CAST(l.l_shipdate AS DATE) AS OpenDate_Typed,
       s.s_name AS Department,
       p.p_type AS DishGroup,
       CAST(p.p_partkey AS VARCHAR) AS DishId,
       CAST(l.l_orderkey AS VARCHAR) AS UniqOrderId_Id,
       {CURRENCY_CASE} AS Currencies_Currency,
       l.l_extendedprice AS DishSumInt,
       l.l_quantity AS DishAmountInt,
       CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS DishDiscountSumInt,
       'http://src' || CAST(s.s_nationkey AS VARCHAR) AS url
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN part p ON l.l_partkey = p.p_partkey
"""

TRANSACTIONS_RAW = """
SELECT CAST(o_orderdate AS DATE) AS DateTime_DateTyped,
       'Store#' || CAST(o_custkey % 7 AS VARCHAR) AS Department,
       o_orderstatus AS TransactionType,
       o_orderpriority AS Product_Category,
       o_totalprice AS Sum_Incoming,
       'http://src' || CAST(o_custkey % 25 AS VARCHAR) AS url
FROM orders
"""

RATES = """
SELECT d AS date,
       CAST(1 AS DECIMAL(12,6)) AS rub,
       CASE WHEN n % 11 = 0 THEN NULL ELSE CAST((1400 + n % 50) / 100 AS DECIMAL(12,6)) END AS gel,
       CASE WHEN n % 13 = 0 THEN NULL ELSE CAST((200 + n % 30) / 1000 AS DECIMAL(12,6)) END AS amd,
       CAST((80 + n % 20) / 100 AS DECIMAL(12,6)) AS kgs,
       CAST((9000 + n % 40) / 100 AS DECIMAL(12,6)) AS usd
FROM (
  SELECT CAST(g.ts AS DATE) AS d, date_diff('day', DATE '1994-12-01', CAST(g.ts AS DATE)) AS n
  FROM generate_series(TIMESTAMP '1994-12-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) AS g(ts)
) t
WHERE n % 7 NOT IN (5, 6) AND NOT (n % 400 BETWEEN 200 AND 230)
"""

LONG_RATES = """
SELECT date AS rate_date, 'GEL' AS ccy, gel AS rate FROM rates
UNION ALL SELECT date, 'AMD', amd FROM rates
UNION ALL SELECT date, 'KGS', kgs FROM rates
"""


def _fx_sql(ccy_list_sql: str, measures: list[str], extra_long: str = "") -> str:
    """Row-level conversion over the whole load window, 7-day chunks, 10-day lookback."""
    rub_cols = ",\n       ".join(
        f"CAST(ROUND(TRY_CAST({m} AS DECIMAL(18,4)) * fx_rate, 4) AS DOUBLE) AS {m}_RUB" for m in measures)
    return f"""
WITH sales_raw AS ({SALES_RAW}),
rates AS ({RATES}),
long AS ({LONG_RATES}{extra_long}),
facts AS (
  SELECT *,
         upper(trim(coalesce(nullif(Currencies_Currency, ''), 'RUB'))) AS ccy,
         DATE '1995-01-01' + CAST(floor(date_diff('day', DATE '1995-01-01', OpenDate_Typed) / 7) * 7 AS INTEGER) AS cs
  FROM sales_raw
  WHERE OpenDate_Typed >= DATE '1995-01-01' AND OpenDate_Typed <= DATE '2001-12-31'
),
chunks AS (
  SELECT cs, EXISTS (SELECT 1 FROM rates r
                     WHERE r.date >= k.cs - 10 AND r.date <= least(k.cs + 6, DATE '2001-12-31')) AS available
  FROM (SELECT DISTINCT cs FROM facts) k
),
resolved AS (
  SELECT f.*, c.available, ex.rate_date AS ex_date, ex.rate AS ex_rate,
         (SELECT max(r.rate_date) FROM long r
          WHERE r.ccy = f.ccy AND r.rate IS NOT NULL
            AND r.rate_date <= f.OpenDate_Typed AND r.rate_date >= f.cs - 10) AS fb_date
  FROM facts f
  JOIN chunks c ON c.cs = f.cs
  LEFT JOIN long ex ON ex.ccy = f.ccy AND ex.rate_date = f.OpenDate_Typed
),
final AS (
  SELECT r.*,
         CASE WHEN NOT r.available THEN NULL
              WHEN r.ccy = 'RUB' THEN CAST(1 AS DECIMAL(12,6))
              WHEN r.ccy NOT IN ({ccy_list_sql}) THEN NULL
              WHEN r.ex_date IS NOT NULL THEN r.ex_rate
              ELSE fb.rate END AS fx_rate
  FROM resolved r
  LEFT JOIN long fb ON fb.ccy = r.ccy AND fb.rate_date = r.fb_date
)
SELECT OpenDate_Typed, Department, DishGroup, DishId, UniqOrderId_Id, Currencies_Currency,
       DishSumInt, DishAmountInt, DishDiscountSumInt, url,
       {rub_cols}
FROM final
"""


def _report_sales() -> str:
    return f"""
WITH sales_raw AS ({SALES_RAW})
SELECT OpenDate_Typed, Department, DishGroup, Currencies_Currency,
       CAST(SUM(TRY_CAST(DishSumInt AS DECIMAL(18,4))) AS DOUBLE) AS DishSumInt,
       CAST(SUM(TRY_CAST(DishAmountInt AS DECIMAL(18,4))) AS DOUBLE) AS DishAmountInt,
       CAST(SUM(TRY_CAST(DishDiscountSumInt AS DECIMAL(18,4))) AS DOUBLE) AS DishDiscountSumInt
FROM sales_raw
WHERE OpenDate_Typed >= DATE '1995-01-01' AND OpenDate_Typed < DATE '2002-01-01'
GROUP BY OpenDate_Typed, Department, DishGroup, Currencies_Currency
"""


def _report_transactions() -> str:
    return f"""
WITH t AS ({TRANSACTIONS_RAW})
SELECT DateTime_DateTyped, Department, TransactionType, Product_Category,
       CAST(SUM(TRY_CAST(Sum_Incoming AS DECIMAL(18,4))) AS DOUBLE) AS Sum_Incoming,
       CAST(SUM(TRY_CAST(Sum_Incoming AS DECIMAL(18,4))) AS DOUBLE)
         / CAST(COUNT(TRY_CAST(Sum_Incoming AS DECIMAL(18,4))) AS DOUBLE) AS Sum_Incoming_Avg
FROM t
WHERE DateTime_DateTyped >= DATE '1995-01-01' AND DateTime_DateTyped < DATE '2002-01-01'
GROUP BY DateTime_DateTyped, Department, TransactionType, Product_Category
"""


def _fx_exact() -> str:
    return f"""
WITH sales_raw AS ({SALES_RAW}),
rates AS ({RATES}),
long AS ({LONG_RATES}),
facts AS (SELECT *, upper(trim(coalesce(nullif(Currencies_Currency, ''), 'RUB'))) AS ccy FROM sales_raw)
SELECT f.OpenDate_Typed, f.Department, f.DishGroup, f.DishId, f.UniqOrderId_Id, f.Currencies_Currency,
       f.DishSumInt, f.DishAmountInt, f.DishDiscountSumInt, f.url,
       CAST(CASE WHEN f.ccy = 'RUB' THEN CAST(1 AS DECIMAL(12,6)) ELSE l.rate END AS DOUBLE) AS rate
FROM facts f LEFT JOIN long l ON l.ccy = f.ccy AND l.rate_date = f.OpenDate_Typed
"""


MESSY_RAW = f"""
SELECT CASE k4 WHEN 0 THEN d WHEN 1 THEN t WHEN 2 THEN t || '.250' ELSE '29.02.2000' END AS "OpenDate.Typed",
       CASE WHEN l_linenumber = 6 THEN ''
            ELSE CASE k4 WHEN 0 THEN t WHEN 1 THEN t || '.5' WHEN 2 THEN t || 'Z' ELSE t || '.1234567' END
       END AS CloseTime,
       CASE WHEN l_linenumber = 5 THEN '' ELSE s_name END AS Department,
       p_type AS DishGroup,
       CAST(p_partkey AS VARCHAR) AS DishId,
       CAST(l_orderkey AS VARCHAR) AS "UniqOrderId.Id",
       {CURRENCY_CASE} AS "Currencies.Currency",
       CASE WHEN l_linenumber = 7 THEN '' WHEN l_quantity = 13 THEN 'abc' WHEN l_quantity = 17 THEN '1d'
            ELSE (CASE WHEN units >= 1000 THEN CAST(units // 1000 AS VARCHAR) || ' ' || lpad(CAST(units % 1000 AS VARCHAR), 3, '0')
                       ELSE CAST(units AS VARCHAR) END) || ',' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')
       END AS DishSumInt,
       CAST(l_quantity AS VARCHAR) AS DishAmountInt,
       CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS VARCHAR) AS DishDiscountSumInt,
       'x' AS "Extra-Field",
       'ignored' AS url,
       'src' || CAST(s_nationkey AS VARCHAR) AS _source,
       cf AS _chunk_from,
       cf + 6 AS _chunk_to
FROM (
  SELECT l.*, s.*, p.*, l.l_orderkey % 4 AS k4,
         CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) AS d,
         CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) || 'T' || lpad(CAST(l.l_linenumber AS VARCHAR), 2, '0') || ':30:15' AS t,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) AS cents,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) // 100 AS units,
         DATE '1995-01-01' + CAST(floor(date_diff('day', DATE '1995-01-01', CAST(l.l_shipdate AS DATE)) / 7) * 7 AS INTEGER) AS cf
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
) x
"""

LANDED = f"""
SELECT "OpenDate.Typed" AS OpenDate_Typed, CloseTime, Department, DishGroup, DishId,
       "UniqOrderId.Id" AS UniqOrderId_Id, "Currencies.Currency" AS Currencies_Currency,
       DishSumInt, DishAmountInt, DishDiscountSumInt,
       CASE WHEN regexp_matches(_source, '^https?://') THEN _source ELSE 'http://' || _source END AS url,
       _chunk_from, _chunk_to
FROM ({MESSY_RAW}) m
"""

NUMBER_RE = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)\s*$"
TS_RE = r"^(\d{4})-(\d{1,2})-(\d{1,2})[Tt](\d{1,2}):(\d{1,2}):(\d{1,2})(\.(\d{1,6}))?$"
DATE_RE = r"^\d{4}-\d{1,2}-\d{1,2}$"


def _num(c: str) -> str:
    cleaned = f"replace(replace({c}, ' ', ''), ',', '.')"
    return (f"CASE WHEN {c} IS NULL OR {c} = '' THEN NULL "
            f"WHEN {c} = 'true' THEN 1.0 WHEN {c} = 'false' THEN 0.0 "
            f"WHEN regexp_matches({cleaned}, '{NUMBER_RE}') THEN TRY_CAST({cleaned} AS DOUBLE) END")


def _ts(c: str) -> str:
    g = lambda i: f"regexp_extract({c}, '{TS_RE}', {i})"
    norm = (f"{g(1)} || '-' || lpad({g(2)}, 2, '0') || '-' || lpad({g(3)}, 2, '0') || ' ' || "
            f"lpad({g(4)}, 2, '0') || ':' || lpad({g(5)}, 2, '0') || ':' || lpad({g(6)}, 2, '0') || '.' || rpad({g(8)}, 6, '0')")
    return (f"CASE WHEN regexp_matches({c}, '{TS_RE}') AND substr({c}, 1, 4) <> '0000' "
            f"THEN TRY_CAST({norm} AS TIMESTAMP) END")


def _date(c: str) -> str:
    head = f"split_part({c}, 'T', 1)"
    return (f"CASE WHEN regexp_matches({head}, '{DATE_RE}') AND substr({head}, 1, 4) <> '0000' "
            f"THEN TRY_CAST({head} AS DATE) END")


TYPED = f"""
SELECT {_date('OpenDate_Typed')} AS OpenDate_Typed,
       {_ts('CloseTime')} AS CloseTime,
       nullif(Department, '') AS Department, nullif(DishGroup, '') AS DishGroup, nullif(DishId, '') AS DishId,
       nullif(UniqOrderId_Id, '') AS UniqOrderId_Id, nullif(Currencies_Currency, '') AS Currencies_Currency,
       {_num('DishSumInt')} AS DishSumInt, {_num('DishAmountInt')} AS DishAmountInt,
       {_num('DishDiscountSumInt')} AS DishDiscountSumInt,
       url, _chunk_from, _chunk_to
FROM ({LANDED}) n
"""

DEFAULT_TEXT = "не задана"

FILLED = f"""
SELECT OpenDate_Typed, CloseTime,
       coalesce(Department, '{DEFAULT_TEXT}') AS Department, coalesce(DishGroup, '{DEFAULT_TEXT}') AS DishGroup,
       coalesce(DishId, '{DEFAULT_TEXT}') AS DishId, coalesce(UniqOrderId_Id, '{DEFAULT_TEXT}') AS UniqOrderId_Id,
       coalesce(Currencies_Currency, '{DEFAULT_TEXT}') AS Currencies_Currency,
       DishSumInt, DishAmountInt, DishDiscountSumInt,
       coalesce(url, '{DEFAULT_TEXT}') AS url, _chunk_from, _chunk_to
FROM ({TYPED}) t
"""

FILLED_COLS = ("OpenDate_Typed, CloseTime, Department, DishGroup, DishId, UniqOrderId_Id, Currencies_Currency, "
               "DishSumInt, DishAmountInt, DishDiscountSumInt, url")


# landed lines that are cut off, and the one field more that records of every fifth order have
CUT = "CAST(DishId AS BIGINT) % 97 = 0"
GUEST = "CAST(UniqOrderId_Id AS BIGINT) % 5 = 0"

CONVERTED = f"""
WITH rows AS (SELECT * FROM ({FILLED}) f WHERE NOT ({CUT})),
rates AS ({RATES}),
long AS ({LONG_RATES}),
facts AS (
  SELECT *, upper(trim(coalesce(nullif(Currencies_Currency, ''), 'RUB'))) AS ccy, _chunk_from AS cs FROM rows
),
chunks AS (
  SELECT cs, EXISTS (SELECT 1 FROM rates r
                     WHERE r.date >= k.cs - 10 AND r.date <= least(k.cs + 6, DATE '2001-12-31')) AS available
  FROM (SELECT DISTINCT cs FROM facts) k
),
resolved AS (
  SELECT f.*, c.available, ex.rate_date AS ex_date, ex.rate AS ex_rate,
         (SELECT max(r.rate_date) FROM long r
          WHERE r.ccy = f.ccy AND r.rate IS NOT NULL
            AND r.rate_date <= f.OpenDate_Typed AND r.rate_date >= f.cs - 10) AS fb_date
  FROM facts f JOIN chunks c ON c.cs = f.cs
  LEFT JOIN long ex ON ex.ccy = f.ccy AND ex.rate_date = f.OpenDate_Typed
),
final AS (
  SELECT r.*,
         CASE WHEN NOT r.available THEN NULL
              WHEN r.ccy = 'RUB' THEN CAST(1 AS DECIMAL(12,6))
              WHEN r.ccy NOT IN ('GEL', 'AMD', 'KGS') THEN NULL
              WHEN r.ex_date IS NOT NULL THEN r.ex_rate
              ELSE fb.rate END AS fx_rate
  FROM resolved r LEFT JOIN long fb ON fb.ccy = r.ccy AND fb.rate_date = r.fb_date
),
conv AS (
  SELECT *,
         ROUND(TRY_CAST(DishSumInt AS DECIMAL(18,4)) * fx_rate, 4) AS s_rub,
         ROUND(TRY_CAST(DishAmountInt AS DECIMAL(18,4)) * fx_rate, 4) AS a_rub,
         ROUND(TRY_CAST(DishDiscountSumInt AS DECIMAL(18,4)) * fx_rate, 4) AS d_rub
  FROM final
)
"""


def _load_summary() -> str:
    return f"""{CONVERTED}
SELECT url, _chunk_from AS chunk_from,
       count(*) AS rows_in,
       count_if(OpenDate_Typed IS NOT NULL) AS inserted,
       count_if(OpenDate_Typed IS NULL) AS rejected,
       0 AS malformed,
       count_if(DishSumInt IS NOT NULL AND s_rub IS NULL)
         + count_if(DishAmountInt IS NOT NULL AND a_rub IS NULL)
         + count_if(DishDiscountSumInt IS NOT NULL AND d_rub IS NULL) AS unconverted,
       count(*) + count_if({GUEST}) AS unknown_values
FROM conv
GROUP BY url, _chunk_from
UNION ALL
SELECT url, CAST(NULL AS DATE), count(*), 0, 0, count(*), 0, 0 FROM ({FILLED}) f WHERE {CUT} GROUP BY url
"""


def _load_unknown_fields() -> str:
    return f"""
WITH f AS (SELECT url, UniqOrderId_Id, CAST(DishId AS BIGINT) AS part FROM ({FILLED}) x WHERE NOT ({CUT})),
names AS (SELECT url, 'Extra-Field' AS field_name FROM f
          UNION ALL SELECT url, 'Guest.Num-' || CAST(part % 3 AS VARCHAR) FROM f WHERE {GUEST})
SELECT field_name, count(*) AS n_rows, count(DISTINCT url) AS n_sources FROM names GROUP BY field_name
"""


def _load_pipeline() -> str:
    return f"""{CONVERTED}
SELECT {FILLED_COLS}, CAST(s_rub AS DOUBLE) AS DishSumInt_RUB, CAST(a_rub AS DOUBLE) AS DishAmountInt_RUB,
       CAST(d_rub AS DOUBLE) AS DishDiscountSumInt_RUB
FROM conv WHERE OpenDate_Typed IS NOT NULL
"""


def _load_rejects() -> str:
    head = " || ".join(f"""'{"," if i else "{"}"{c}":"' || "{c}" || '"'""" for i, c in enumerate(
        ["OpenDate.Typed", "CloseTime", "Department", "DishGroup", "DishId", "UniqOrderId.Id", "Currencies.Currency"]))
    return f"""
SELECT UniqOrderId_Id AS order_id, url, 'null in non-nullable column OpenDate_Typed' AS error,
       CAST(_chunk_from AS VARCHAR) || ' – ' || CAST(_chunk_to AS VARCHAR) AS chunk, CAST(NULL AS VARCHAR) AS raw, true AS has_raw,
       replace(url, 'http://', '') AS source
FROM ({FILLED}) x WHERE OpenDate_Typed IS NULL AND NOT ({CUT})
UNION ALL
SELECT NULL, NULL, 'malformed record', '', left({head}, 70), true, _source FROM ({MESSY_RAW}) m WHERE {CUT}
"""


def _fx_landed() -> str:
    return f"""
WITH rates AS ({RATES}),
long AS ({LONG_RATES}),
s0 AS (
  SELECT CAST(l.l_shipdate AS DATE) AS d, l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_suppkey, s.s_nationkey AS n,
         DATE '1995-01-01' + CAST(s.s_nationkey % 7 AS INTEGER) AS anchor
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey
),
facts AS (
  SELECT row_number() OVER () AS rid, d AS OpenDate_Typed, CAST(l_orderkey AS VARCHAR) AS UniqOrderId_Id, l_linenumber AS line,
         {CURRENCY_CASE} AS Currencies_Currency,
         CASE WHEN n % 3 = 0 THEN (CASE WHEN n % 4 = 0 THEN 'GEL' ELSE 'RUB' END) ELSE '' END AS connection_currency,
         CASE l_linenumber WHEN 5 THEN CAST(0.00004 AS DOUBLE) WHEN 6 THEN CAST(2.0e14 AS DOUBLE) + l_quantity ELSE l_extendedprice END AS DishSumInt,
         'http://src' || CAST(n AS VARCHAR) AS url,
         anchor + CAST(floor(date_diff('day', anchor, d) / 7) * 7 AS INTEGER) - CASE WHEN l_linenumber = 7 THEN 7 ELSE 0 END AS _chunk_from
  FROM s0
),
keyed AS (
  SELECT *, _chunk_from + 6 AS _chunk_to, least(_chunk_from + 6, DATE '2001-12-31') AS ct,
         upper(trim(coalesce(nullif(connection_currency, ''), nullif(Currencies_Currency, ''), 'RUB'))) AS ccy
  FROM facts
),
lookups AS (
  SELECT DISTINCT ccy, OpenDate_Typed AS d, _chunk_from AS cf, ct FROM keyed
),
resolved AS (
  SELECT k.*,
         EXISTS (SELECT 1 FROM rates r WHERE r.date BETWEEN k.cf - 10 AND k.ct) AS available,
         k.d <= k.ct AND EXISTS (SELECT 1 FROM rates r WHERE r.date = k.d) AS exact,
         (SELECT max(r.rate) FROM long r WHERE r.ccy = k.ccy AND r.rate_date = k.d) AS own_rate,
         (SELECT max(r.rate_date) FROM long r WHERE r.ccy = k.ccy AND r.rate IS NOT NULL
            AND r.rate_date BETWEEN k.cf - 10 AND least(k.d, k.ct)) AS last_date
  FROM lookups k
),
priced AS (
  SELECT r.ccy, r.d, r.cf, CASE WHEN NOT available THEN NULL
              WHEN r.ccy = 'RUB' THEN CAST(1 AS DECIMAL(12,6))
              WHEN r.ccy NOT IN ('GEL', 'AMD', 'KGS') THEN NULL
              WHEN exact THEN own_rate ELSE l.rate END AS fx_rate
  FROM resolved r LEFT JOIN long l ON l.ccy = r.ccy AND l.rate_date = r.last_date
)
SELECT k.OpenDate_Typed, k.UniqOrderId_Id, k.line, k.Currencies_Currency, k.connection_currency, k.DishSumInt, k.url, k._chunk_from, k._chunk_to,
       CAST(CAST(ROUND(CAST(CAST(k.DishSumInt AS VARCHAR) AS DECIMAL(24,6)) * p.fx_rate, 4) AS VARCHAR) AS DOUBLE) AS DishSumInt_RUB
FROM keyed k JOIN priced p ON p.ccy = k.ccy AND p.d = k.OpenDate_Typed AND p.cf = k._chunk_from
"""


def _dropped_fields() -> str:
    fields = ["OpenDate.Typed", "CloseTime", "Department", "DishGroup", "DishId", "UniqOrderId.Id",
              "Currencies.Currency", "DishSumInt", "DishAmountInt", "DishDiscountSumInt", "Extra-Field", "url"]
    mart = ["OpenDate_Typed", "Department", "DishGroup", "DishId", "UniqOrderId_Id", "Currencies_Currency",
            "DishSumInt", "DishAmountInt", "DishDiscountSumInt", "url"]
    unions = "\n  UNION ALL ".join(f"""SELECT '{f}' AS field_name, "{f}" AS v FROM m""" for f in fields)
    mart_list = ", ".join(f"'{c}'" for c in mart)
    return f"""
WITH m AS ({MESSY_RAW}),
kv AS ({unions})
SELECT field_name, count(*) AS n_rows
FROM kv
WHERE v <> '' AND translate(field_name, '.-', '__') NOT IN ({mart_list})
GROUP BY field_name
"""


MART_COLS = ("OpenDate_Typed, Department, DishGroup, DishId, UniqOrderId_Id, Currencies_Currency, "
             "DishSumInt, DishAmountInt, DishDiscountSumInt, url")


def _replace_range() -> str:
    return f"""
WITH sales_raw AS ({SALES_RAW}),
old AS (
  SELECT OpenDate_Typed, Department, DishGroup, DishId, UniqOrderId_Id, Currencies_Currency,
         DishSumInt, CAST(NULL AS DOUBLE) AS DishAmountInt, CAST(DishDiscountSumInt AS DOUBLE) AS DishDiscountSumInt, url
  FROM sales_raw
),
batch AS (
  SELECT OpenDate_Typed, Department, DishGroup, DishId, UniqOrderId_Id, Currencies_Currency,
         DishSumInt + 100.0 AS DishSumInt, DishAmountInt, CAST(DishDiscountSumInt AS DOUBLE) AS DishDiscountSumInt, url
  FROM sales_raw
  WHERE OpenDate_Typed BETWEEN DATE '1998-03-01' AND DATE '1998-04-15'
    AND url IN ('http://src0', 'http://src1', 'http://src2', 'http://src3', 'http://src4')
    AND NOT (url = 'http://src1' AND OpenDate_Typed BETWEEN DATE '1998-03-08' AND DATE '1998-03-14')
    AND DishGroup <> 'SMALL'
  UNION ALL
  SELECT OpenDate_Typed, Department, DishGroup, DishId, UniqOrderId_Id, Currencies_Currency,
         DishSumInt + 100.0, DishAmountInt, CAST(DishDiscountSumInt AS DOUBLE), url
  FROM sales_raw
  WHERE OpenDate_Typed = DATE '1998-05-02' AND url IN ('http://src0', 'http://src1', 'http://src2', 'http://src3', 'http://src4')
),
ranges AS (
  SELECT DISTINCT url,
         DATE '1998-03-01' + CAST(floor(date_diff('day', DATE '1998-03-01', OpenDate_Typed) / 7) * 7 AS INTEGER) AS r_from
  FROM batch WHERE OpenDate_Typed <= DATE '1998-04-15'
)
SELECT {MART_COLS} FROM old o
WHERE NOT EXISTS (SELECT 1 FROM ranges r
                  WHERE r.url = o.url AND o.OpenDate_Typed BETWEEN r.r_from AND least(r.r_from + 6, DATE '1998-04-15'))
UNION ALL
SELECT {MART_COLS} FROM batch
"""


def _month(c: str) -> str:
    return f"CAST(year({c}) * 100 + month({c}) AS INTEGER)"


CATEGORIES = """
SELECT r_regionkey AS id, r_name AS name, 'Stores of ' || r_name AS description, r_regionkey <> 3 AS is_active
FROM region
"""

SOURCES = """
SELECT n_nationkey AS id, n_name AS name,
       CASE WHEN n_nationkey % 2 = 0 THEN 'http://src' || CAST(n_nationkey AS VARCHAR)
            ELSE 'src' || CAST(n_nationkey AS VARCHAR) END AS api_url,
       'user' || CAST(n_nationkey AS VARCHAR) AS login,
       CASE WHEN n_nationkey % 4 = 0 THEN 'GEL' ELSE 'RUB' END AS currency,
       CASE WHEN n_regionkey = 4 THEN NULL ELSE n_regionkey END AS category_id,
       n_nationkey % 3 <> 1 AS load_weather,
       CASE n_nationkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ''
            ELSE 'key' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') || 'abcdef' END AS cloud_api_key
FROM nation
"""

TARGETS = """
SELECT r_regionkey AS id, 'target-' || CAST(r_regionkey AS VARCHAR) AS name,
       'mart' || CAST(r_regionkey AS VARCHAR) || '.local' AS host, 9000 AS port,
       'loader' AS "user", 'default' AS storage_policy
FROM region
"""

TEMPLATES = """
SELECT length(name) * 1000 + ascii(name) AS id, name, 'SALES' AS report_type
FROM (SELECT DISTINCT lower(c_mktsegment) AS name FROM customer) x
"""

TASKS = f"""
SELECT 'task-' || CAST(c.c_custkey AS VARCHAR) AS id, c.c_name AS name, c.c_nationkey AS source_id,
       CAST(c.c_custkey % 6 AS INTEGER) AS target_id, p.id AS template_id,
       'mart.' || p.name || '_' || CAST(c.c_nationkey AS VARCHAR) AS dataset_name,
       CAST(7 + c.c_custkey % 30 AS INTEGER) AS days_offset_start,
       CAST(c.c_custkey % 5 AS INTEGER) AS days_offset_end,
       c.c_custkey % 4 <> 0 AS is_active
FROM customer c JOIN ({TEMPLATES}) p ON lower(c.c_mktsegment) = p.name
"""

CFG = f"""categories AS ({CATEGORIES}), sources AS ({SOURCES}), targets AS ({TARGETS}),
templates AS ({TEMPLATES}), tasks AS ({TASKS})"""

D = "CAST({} AS DOUBLE)"

OUTLETS = """
SELECT 'org-' || CAST(s_suppkey AS VARCHAR) AS id, s_nationkey AS source_id, s_suppkey AS seq,
       '  ' || s_name || ' ' AS name,
       CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE CAST(s_suppkey % 1000 AS VARCHAR) END AS code,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE ' Street ' || CAST(s_nationkey AS VARCHAR) || ' ' END AS restaurantAddress,
       'Country ' || CAST(s_nationkey % 3 AS VARCHAR) AS country,
       CASE WHEN s_suppkey % 17 = 0 THEN CAST(0 AS DOUBLE)
            ELSE CAST(55.0 AS DOUBLE) + CAST(s_suppkey % 20 AS DOUBLE) * CAST(0.02 AS DOUBLE) END AS latitude,
       CASE WHEN s_suppkey % 17 = 0 THEN CAST(0 AS DOUBLE)
            ELSE CAST(37.0 AS DOUBLE) + CAST(s_suppkey % 7 AS DOUBLE) * CAST(0.03 AS DOUBLE) END AS longitude,
       '77' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS inn,
       CASE WHEN s_suppkey % 4 = 0 THEN NULL WHEN s_suppkey % 4 = 1 THEN 'GEL' ELSE 'RUB' END AS currencyIsoName,
       CASE WHEN s_suppkey % 3 = 0 THEN 'CourierAndSelfService' ELSE 'SelfServiceOnly' END AS deliveryServiceType,
       '8.' || CAST(s_suppkey % 4 AS VARCHAR) AS version,
       s_acctbal
FROM supplier
"""

OUTLET_REF = f"""
SELECT o.id AS org_id, trim(coalesce(o.name, '')) AS org_name, coalesce(o.code, '') AS org_code,
       trim(coalesce(o.restaurantAddress, '')) AS address, trim(coalesce(o.country, '')) AS country,
       CASE WHEN o.latitude IS NULL OR o.latitude = 0 THEN NULL ELSE o.latitude END AS lat,
       CASE WHEN o.longitude IS NULL OR o.longitude = 0 THEN NULL ELSE o.longitude END AS lon,
       coalesce(o.inn, '') AS inn, coalesce(nullif(o.currencyIsoName, ''), 'RUB') AS currency,
       coalesce(o.deliveryServiceType, '') AS delivery_type, coalesce(o.version, '') AS pos_version,
       substring(s.cloud_api_key, 1, 8) || '...' AS api_key_hint,
       o.source_id, o.seq, o.s_acctbal
FROM ({OUTLETS}) o
JOIN ({SOURCES}) s ON o.source_id = s.id
WHERE s.load_weather AND s.cloud_api_key IS NOT NULL AND s.cloud_api_key <> ''
"""

WEATHER_DAILY = """
SELECT CAST(user_id % 10 AS INTEGER) AS location, CAST(ts AS DATE) AS day,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS temp_avg,
       MIN(value) AS temp_min, MAX(value) AS temp_max,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS precipitation_mm,
       CAST(COUNT(*) AS DOUBLE) AS cloud_cover_pct,
       MAX(value) - MIN(value) AS wind_speed_ms
FROM events GROUP BY 1, 2
"""

WEATHER_NEW = f"""
SELECT location, CASE WHEN day < DATE '2024-01-20' THEN 'history' ELSE 'forecast' END AS part, day AS date,
       temp_avg, temp_min, temp_max, precipitation_mm, cloud_cover_pct, wind_speed_ms
FROM ({WEATHER_DAILY}) d
WHERE NOT (location = 7 AND day >= DATE '2024-01-20')
"""


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"6371.0 * 2 * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))")


def _outlet_stations() -> str:
    hv = _haversine("o.lat", "o.lon", "s.lat", "s.lon")
    return f"""
WITH o AS ({OUTLET_REF}),
st AS (SELECT DISTINCT CAST(user_id % 10 AS INTEGER) AS station_id FROM events),
s AS (SELECT station_id,
             CAST(55.01 AS DOUBLE) + CAST(station_id AS DOUBLE) * CAST(0.04 AS DOUBLE) AS lat,
             CAST(37.01 AS DOUBLE) + CAST(station_id % 3 AS DOUBLE) * CAST(0.05 AS DOUBLE) AS lon FROM st)
SELECT o.org_id, s.station_id, round({hv}, 6) AS distance_km
FROM o, s
WHERE o.lat IS NOT NULL AND o.lon IS NOT NULL AND {hv} <= 5.0
"""


def _weather_by_outlet() -> str:
    cols = "temp_avg, temp_min, temp_max, precipitation_mm, cloud_cover_pct, wind_speed_ms"
    return f"""
WITH o AS (SELECT org_id, org_name, lat, lon, CAST(seq % 10 AS INTEGER) AS cluster,
                  'cluster-' || CAST(seq % 10 AS VARCHAR) AS city_cluster
           FROM ({OUTLET_REF}) r WHERE lat IS NOT NULL AND lon IS NOT NULL),
nw AS ({WEATHER_NEW}),
old_rows AS (
  SELECT d.day AS date, d.temp_avg + 0.5 AS temp_avg, d.temp_min, d.temp_max, d.precipitation_mm,
         d.cloud_cover_pct, d.wind_speed_ms, o.org_id, o.org_name, o.lat, o.lon, o.city_cluster, 'old' AS load
  FROM ({WEATHER_DAILY}) d JOIN o ON o.cluster = d.location),
new_rows AS (
  SELECT w.date, {cols}, o.org_id, o.org_name, o.lat, o.lon, o.city_cluster, 'new' AS load
  FROM nw w JOIN o ON o.cluster = w.location)
, every_row AS (
  SELECT *, 0 AS v FROM old_rows r
  WHERE NOT (r.date BETWEEN DATE '2024-01-10' AND DATE '2024-01-30'
             AND r.org_id IN (SELECT org_id FROM new_rows WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-30'))
  UNION ALL SELECT *, 1 FROM new_rows WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-30')
SELECT * EXCLUDE (v) FROM every_row QUALIFY row_number() OVER (PARTITION BY date, org_id ORDER BY v DESC) = 1
"""


def _latest_by_key() -> str:
    return f"""
WITH b AS (SELECT org_id, org_name, lat, lon, s_acctbal FROM ({OUTLET_REF}) r),
v AS (
  SELECT org_id, org_name, lat, lon, TIMESTAMP '2024-01-10 06:00:00' AS synced_at, 1 AS seq FROM b
  UNION ALL SELECT org_id, org_name || ' (moved)', lat, lon, TIMESTAMP '2024-01-20 06:00:00', 2 FROM b WHERE s_acctbal > 5000
  UNION ALL SELECT org_id, org_name || ' (renamed)', lat, lon, TIMESTAMP '2024-01-20 06:00:00', 3 FROM b WHERE s_acctbal > 8000
)
SELECT org_id, org_name, lat, lon, synced_at, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY org_id ORDER BY synced_at DESC, seq DESC) AS rn FROM v) x
WHERE rn = 1
"""


_TASK_WINDOWS = """
cfg AS (
  SELECT t.id AS task_id,
         CASE WHEN regexp_matches(s.api_url, '^https?://') THEN s.api_url ELSE 'http://' || s.api_url END AS source_url,
         DATE '1998-06-01' - t.days_offset_start AS date_from, DATE '1998-06-01' - t.days_offset_end AS date_to
  FROM tasks t JOIN sources s ON t.source_id = s.id JOIN targets g ON t.target_id = g.id
  JOIN templates p ON t.template_id = p.id
  WHERE t.is_active)"""


def _multi_source_window() -> str:
    return f"""
WITH {CFG}, sales_raw AS ({SALES_RAW}), {_TASK_WINDOWS},
days AS (SELECT DISTINCT url, OpenDate_Typed AS day FROM sales_raw),
held AS (SELECT d.url, d.day, count(*) AS n_tasks FROM days d JOIN cfg c ON c.source_url = d.url AND d.day BETWEEN c.date_from AND c.date_to GROUP BY ALL)
SELECT c.task_id, r.OpenDate_Typed, r.UniqOrderId_Id, r.DishId, r.DishSumInt, r.url, h.n_tasks
FROM cfg c JOIN sales_raw r ON r.url = c.source_url AND r.OpenDate_Typed BETWEEN c.date_from AND c.date_to
JOIN held h ON h.url = r.url AND h.day = r.OpenDate_Typed
"""


def _task_coverage() -> str:
    return f"""
WITH {CFG}, {_TASK_WINDOWS}
SELECT source_url, CAST(g.ts AS DATE) AS day, count(*) AS n_tasks
FROM cfg, LATERAL generate_series(CAST(date_from AS TIMESTAMP), CAST(date_to AS TIMESTAMP), INTERVAL 1 DAY) AS g(ts)
GROUP BY ALL
"""


def _date_chunks() -> str:
    return f"""
WITH {CFG},
cfg AS (
  SELECT t.id AS task_id, DATE '1998-06-01' - t.days_offset_start AS date_from,
         DATE '1998-06-01' - t.days_offset_end AS date_to
  FROM tasks t JOIN sources s ON t.source_id = s.id JOIN targets g ON t.target_id = g.id
  JOIN templates p ON t.template_id = p.id
  WHERE t.is_active)
SELECT task_id, date_from, date_to, CAST(g.ts AS DATE) AS chunk_from,
       least(CAST(g.ts AS DATE) + 6, date_to) AS chunk_to
FROM cfg, LATERAL generate_series(CAST(date_from AS TIMESTAMP), CAST(date_to AS TIMESTAMP), INTERVAL 7 DAY) AS g(ts)
"""


def registry() -> dict[str, str]:
    return {
        "report_sales": _report_sales(),
        "report_transactions": _report_transactions(),
        "fx_convert": _fx_sql("'GEL', 'AMD', 'KGS'", ["DishSumInt", "DishAmountInt", "DishDiscountSumInt"]),
        "fx_exact": _fx_exact(),
        "fx_register": _fx_sql("'GEL', 'AMD', 'KGS', 'USD'", ["DishSumInt"],
                               "\nUNION ALL SELECT date, 'USD', usd FROM rates"),
        "normalize_names": f"SELECT {FILLED_COLS} FROM ({LANDED}) x",
        "dropped_fields": _dropped_fields(),
        "coerce_types": f"SELECT {FILLED_COLS} FROM ({TYPED}) x",
        "fill_defaults": f"SELECT {FILLED_COLS} FROM ({FILLED}) x",
        "quarantine": f"""SELECT {FILLED_COLS}, 'null in non-nullable column OpenDate_Typed' AS error,
       _chunk_from, _chunk_to FROM ({FILLED}) x WHERE OpenDate_Typed IS NULL""",
        "load_summary": _load_summary(),
        "fx_landed": _fx_landed(),
        "load_pipeline": _load_pipeline(),
        "load_rejects": _load_rejects(),
        "load_unknown_fields": _load_unknown_fields(),
        "replace_range": _replace_range(),
        "dataset_profile": f"""WITH s AS ({SALES_RAW})
SELECT {_month('OpenDate_Typed')} AS month, count(*) AS rows, min(OpenDate_Typed) AS min_date,
       max(OpenDate_Typed) AS max_date, count(DISTINCT url) AS sources
FROM s GROUP BY 1""",
        "dataset_info": f"""WITH s AS ({SALES_RAW})
SELECT count(*) AS row_count, min(OpenDate_Typed) AS min_date, max(OpenDate_Typed) AS max_date FROM s""",
        "dataset_columns": f"""WITH s AS ({SALES_RAW})
{chr(10).join(("UNION ALL " if i else "") + f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS column_type, count({c}) AS n_values FROM s"
              for i, (c, t) in enumerate(zip(MART_COLS.split(", "), ["date"] + ["string"] * 5 + ["double", "double", "decimal(18,4)", "string"], strict=True)))}""",
        "partition_sizes": f"""WITH s AS ({SALES_RAW})
SELECT {_month('OpenDate_Typed')} AS month, count(*) AS rows, true AS has_bytes, true AS batched FROM s GROUP BY 1""",
        "hot_partition_files": f"""WITH s AS ({SALES_RAW})
SELECT {_month('OpenDate_Typed')} AS month,
       CASE WHEN CAST(UniqOrderId_Id AS BIGINT) % 3 = 0 THEN 'http://hot'
            ELSE 'http://src' || (CAST(substring(url, 11) AS INTEGER) % 3) END AS url, count(*) AS rows, 0 AS overlapping FROM s GROUP BY 1, 2""",
        "reorganize_check": f"""WITH s AS ({SALES_RAW})
SELECT {_month('OpenDate_Typed')} AS month, count(*) AS old_rows, count(*) AS new_rows, true AS same_content FROM s GROUP BY 1""",
        "reorganize_switch": f"""WITH s AS ({SALES_RAW})
SELECT {_month('OpenDate_Typed')} AS month, count(*) AS rows_before, count(*) AS rows_after, false AS first_switch, true AS second_switch FROM s GROUP BY 1""",
        "task_details": f"""WITH {CFG}
SELECT t.id AS task_id, t.name AS task_name, t.dataset_name, t.days_offset_start, t.days_offset_end, t.is_active,
       s.name AS source_name, s.api_url, s.currency AS source_currency, s.category_id,
       g.name AS target_name, g.host, g.port, p.name AS template_name,
       c.name AS category_name, c.is_active AS category_active
FROM tasks t JOIN sources s ON t.source_id = s.id JOIN targets g ON t.target_id = g.id
JOIN templates p ON t.template_id = p.id LEFT JOIN categories c ON s.category_id = c.id""",
        "task_filter": f"""WITH {CFG}
SELECT t.* FROM tasks t JOIN sources s ON t.source_id = s.id JOIN templates p ON t.template_id = p.id
WHERE p.name = 'building' AND t.is_active""",
        "source_categories": f"""WITH {CFG}
SELECT t.id AS task_id, t.name AS task_name, t.source_id, s.name AS source_name, s.api_url,
       c.name AS category_name, c.is_active AS category_active
FROM tasks t JOIN sources s ON t.source_id = s.id LEFT JOIN categories c ON s.category_id = c.id
WHERE s.load_weather AND s.cloud_api_key IS NOT NULL AND s.cloud_api_key <> ''
  AND contains(lower(t.name), lower('CUSTOMER#0'))""",
        "category_counts": f"""WITH {CFG}
SELECT c.id, c.name, count(DISTINCT s.id) AS connection_count, count(t.id) AS task_count
FROM categories c LEFT JOIN sources s ON c.id = s.category_id LEFT JOIN tasks t ON t.source_id = s.id
GROUP BY c.id, c.name""",
        "bulk_update": f"""WITH {CFG}
SELECT t.id, t.name, t.source_id, t.target_id, t.template_id, t.dataset_name,
       CASE WHEN m.id IS NOT NULL THEN 14 ELSE t.days_offset_start END AS days_offset_start,
       CASE WHEN m.id IS NOT NULL THEN 0 ELSE t.days_offset_end END AS days_offset_end,
       t.is_active, m.id IS NOT NULL AS updated
FROM tasks t LEFT JOIN (
  SELECT t2.id FROM tasks t2 JOIN sources s ON t2.source_id = s.id JOIN templates p ON t2.template_id = p.id
  WHERE p.name = 'household' AND t2.is_active) m ON m.id = t.id""",
        "insert_if_absent": f"""WITH sources AS ({SOURCES}),
inc AS (SELECT 'http://src' || CAST(c_custkey % 40 AS VARCHAR) AS api_url,
               'user' || CAST(c_custkey % 40 AS VARCHAR) AS login,
               'pw' || CAST(c_custkey AS VARCHAR) AS password, 1000000 - c_custkey AS rank FROM customer),
d AS (SELECT * FROM inc QUALIFY row_number() OVER (PARTITION BY api_url, login ORDER BY password, rank) = 1)
SELECT api_url, login, password, rank, substring(sha256(api_url || '|' || login), 1, 16) AS name
FROM d WHERE NOT EXISTS (SELECT 1 FROM sources s WHERE s.api_url = d.api_url AND s.login = d.login)""",
        "upsert": f"""WITH sources AS ({SOURCES}),
inc AS (SELECT 'http://src' || CAST(c_custkey % 40 AS VARCHAR) AS api_url, 'user' || CAST(c_custkey % 40 AS VARCHAR) AS login,
               c_name AS name, CASE WHEN c_nationkey % 2 = 0 THEN 'AMD' ELSE 'KGS' END AS currency, c_custkey AS seq FROM customer),
d AS (SELECT * FROM inc QUALIFY row_number() OVER (PARTITION BY api_url, login ORDER BY seq DESC) = 1)
SELECT coalesce(s.api_url, d.api_url) AS api_url, coalesce(s.login, d.login) AS login,
       CASE WHEN s.api_url IS NULL THEN d.name ELSE s.name END AS name, coalesce(d.currency, s.currency) AS currency
FROM sources s FULL OUTER JOIN d ON s.api_url = d.api_url AND s.login = d.login""",
        "task_search": f"""WITH {CFG}
SELECT id, name, dataset_name, split_part(dataset_name, '.', 1) AS db,
       substring(dataset_name, strpos(dataset_name, '.') + 1) AS "table"
FROM tasks WHERE contains(lower(name), 'building') OR contains(lower(dataset_name), 'building')""",
        "config_ingest": """WITH c AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 11 = 0 THEN 'temp' ELSE translate(lower(r_name), ' _', '--') END AS folder,
         translate(lower(n_name), ' _', '--') || '-' || c_custkey AS name,
         CASE WHEN c_custkey % 13 = 0 THEN '.bak' ELSE '.json' END AS ending
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
r AS (SELECT *, CASE WHEN k % 13 = 0 THEN 'name' WHEN k % 11 = 0 THEN 'excluded folder' WHEN k % 7 = 0 THEN 'not json'
                     WHEN k % 5 = 0 THEN 'lacks clickhouse' END AS skip_reason FROM c)
SELECT folder || '/sales_' || name || ending AS relative_path, name AS template_name, folder || '.sales.' || name AS dataset_name,
       CASE WHEN skip_reason IS NULL THEN 'http://src' || k END AS api_url, CASE WHEN skip_reason IS NULL THEN 'user' || k END AS login,
       CASE WHEN skip_reason IS NULL THEN 'mart' || (k % 5) || '.local' END AS host,
       CASE WHEN skip_reason IS NULL THEN substring(sha256('mart' || (k % 5) || '.local:9000|loader'), 1, 16) END AS target_key,
       CASE WHEN skip_reason IS NOT NULL THEN NULL WHEN k % 2 = 1 THEN 'SALES' ELSE 'TRANSACTIONS' END AS report_type, skip_reason
FROM r""",
        "name_clash": f"""WITH {CFG},
cand AS (SELECT c_custkey AS id,
                CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) ELSE c_name || ' copy' END AS name FROM customer)
SELECT id, name FROM cand WHERE lower(name) IN (SELECT lower(name) FROM tasks)""",
        "multi_source_window": _multi_source_window(),
        "task_coverage": _task_coverage(),
        "date_chunks": _date_chunks(),
        "outlet_reference": f"""SELECT org_id, org_name, org_code, address, country, lat, lon, inn, currency,
       delivery_type, pos_version, api_key_hint FROM ({OUTLET_REF}) r""",
        "outlet_responses": f"""SELECT org_id, org_name, org_code, address, country, lat, lon, inn, currency,
       delivery_type, pos_version, api_key_hint FROM ({OUTLET_REF}) r""",
        "outlet_stations": _outlet_stations(),
        "cluster_centroids": f"""SELECT source_id, CAST(seq % 10 AS INTEGER) AS cluster, round(avg(lat), 6) AS c_lat,
       round(avg(lon), 6) AS c_lon, count(*) AS members
FROM ({OUTLET_REF}) r WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY 1, 2""",
        "weather_requests": f"""WITH c AS (
  SELECT source_id, CAST(seq % 10 AS INTEGER) AS cluster, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon, min(seq) AS first_seq
  FROM ({OUTLET_REF}) r WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY 1, 2),
l AS (SELECT *, 'city-' || CAST(cluster % 4 AS VARCHAR) AS city_cluster FROM c
      QUALIFY row_number() OVER (PARTITION BY source_id, cluster % 4 ORDER BY first_seq) = 1)
SELECT source_id, city_cluster, lat AS req_lat, lon AS req_lon, w.part, w.date_from, w.date_to
FROM l, (VALUES ('history', DATE '2023-12-21', DATE '2024-01-19'), ('forecast', DATE '2024-01-20', DATE '2024-01-27')) AS w(part, date_from, date_to)""",
        "outlet_summary": f"""SELECT source_id, count(*) AS outlets,
       count_if(lat IS NOT NULL AND lon IS NOT NULL) AS with_coordinates,
       count(DISTINCT CASE WHEN lat IS NOT NULL AND lon IS NOT NULL
                           THEN CAST(lat AS VARCHAR) || ',' || CAST(lon AS VARCHAR) END) AS distinct_points
FROM ({OUTLET_REF}) r GROUP BY source_id""",
        "weather_explode": WEATHER_NEW,
        "weather_by_outlet": _weather_by_outlet(),
        "weather_table": _weather_by_outlet(),
        "outlet_table": _latest_by_key(),
        "latest_by_key": _latest_by_key(),
        "add_column_default": f"""WITH s AS ({SALES_RAW})
SELECT UniqOrderId_Id, DishId, OpenDate_Typed,
       CASE WHEN OpenDate_Typed < DATE '1998-03-01' THEN 'RUB' WHEN DishAmountInt > 25 THEN 'GEL' END AS currency,
       CASE WHEN OpenDate_Typed >= DATE '1998-03-01' THEN CAST(2.5 AS DOUBLE) END AS rate
FROM s""",
    }
