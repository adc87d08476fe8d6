"""Parameters shared by the registered queries and their SQL oracles."""

from __future__ import annotations

import datetime as dt

from salesmart.operators.template import ReportTemplate

# Report window covering every ship date of the generated data.
REPORT_FROM = dt.date(1995, 1, 1)
REPORT_TO = dt.date(2001, 12, 31)

# Load window of the conversion pipeline: the whole data, 7-day chunks from its start.
LOAD_FROM = dt.date(1995, 1, 1)
LOAD_TO = dt.date(2001, 12, 31)

# Range replaced by the re-load batch, and the sources it covers.
REPLACE_FROM = dt.date(1998, 3, 1)
REPLACE_TO = dt.date(1998, 4, 15)
REPLACE_SOURCES = ["http://src0", "http://src1", "http://src2", "http://src3", "http://src4"]
# the re-load of this source returned nothing for its second chunk
REPLACE_QUIET_SOURCE = "http://src1"
REPLACE_QUIET_FROM = dt.date(1998, 3, 8)
REPLACE_QUIET_TO = dt.date(1998, 3, 14)
# dish group absent from the re-load (its old rows in re-loaded chunks go away)
REPLACE_GONE_GROUP = "SMALL"

# a day past the window, in the next month, that the re-load also brings rows of
REPLACE_LATE_DAY = dt.date(1998, 5, 2)

# Clock of the task windows (WIN-1); a parameter, never the wall clock.
AS_OF = dt.date(1998, 6, 1)

# Catalog filters.
FILTER_TEMPLATE = "building"
UPDATE_TEMPLATE = "household"
TASK_SEARCH = "CUSTOMER#0"
ANY_SEARCH = "Building"

# Weather refresh range and outlet sync times.
WEATHER_FROM = dt.date(2024, 1, 10)
WEATHER_TO = dt.date(2024, 1, 30)
SYNC_1 = dt.datetime(2024, 1, 10, 6, 0, 0)
SYNC_2 = dt.datetime(2024, 1, 20, 6, 0, 0)

SALES_TEMPLATE = ReportTemplate(
    report_type="SALES",
    group_by=("OpenDate.Typed", "Department", "DishGroup", "Currencies.Currency"),
    measures=("DishSumInt", "DishAmountInt", "DishDiscountSumInt"),
)

SALES_MART_TEMPLATE = ReportTemplate(
    report_type="SALES",
    group_by=("OpenDate.Typed", "Department", "DishGroup", "DishId", "UniqOrderId.Id", "Currencies.Currency"),
    measures=("DishSumInt", "DishAmountInt", "DishDiscountSumInt"),
)

TRANSACTIONS_TEMPLATE = ReportTemplate(
    report_type="TRANSACTIONS",
    group_by=("DateTime.DateTyped", "Department", "TransactionType", "Product.Category"),
    measures=("Sum.Incoming", "Sum.Incoming.Avg"),
    measure_kinds={},
)


def _messy_schema():
    from pyspark.sql import types as T

    from salesmart.operators.template import mart_schema

    base = mart_schema(SALES_MART_TEMPLATE, convert_currency=False)
    fields = list(base.fields)
    fields.insert(1, T.StructField("CloseTime", T.TimestampNTZType(), True))
    return T.StructType(fields)


# Mart schema of the landed sales rows: the mart template plus a date-time
# column added later by a schema change (exercises OP-6).
MESSY_SCHEMA = _messy_schema()
MEASURES = ["DishSumInt", "DishAmountInt", "DishDiscountSumInt"]
