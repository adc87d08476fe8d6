"""Report templates: mart schema (SCH-1) and the report aggregation (AGG-1, FLT-1).

A template names a report type, its dimensions (``groupByRowFields``) and
measures (``aggregateFields``). Running it is one ``groupBy().agg()``: a
partial hash aggregate before the shuffle and a final one after it, so the
shuffle carries one row per group and partition, not one per input row.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.names import normalise_name

# Main date field per report type (source name, mart name).
DATE_FIELDS = {
    "SALES": ("OpenDate.Typed", "OpenDate_Typed"),
    "TRANSACTIONS": ("DateTime.DateTyped", "DateTime_DateTyped"),
}

# Dimensions that are never null.
NON_NULLABLE_FIELDS = {"DateTime_DateTyped", "UniqOrderId_Id", "OpenDate_Typed", "url"}

# Numeric dimensions (counters and indexes), stored as numbers.
NUMERIC_FIELDS = {"OrderNum", "HourClose", "HourOpen", "TableNum", "GuestNum"}

# Low-cardinality text dimensions; stored as non-null strings
# (Parquet dictionary-encodes them on its own).
LOW_CARDINALITY_FIELDS = {
    "Department", "Department_Id", "Department_JurPerson", "Department_Code",
    "Department_Category1", "Department_Category2", "Department_Category3",
    "Department_Category4", "Department_Category5",
    "DishCategory", "DishCategory_Id",
    "DishGroup", "DishGroup_TopParent", "DishGroup_SecondParent", "DishGroup_ThirdParent",
    "DishType", "DeletedWithWriteoff", "OrderDeleted", "CookingPlaceType",
    "OrderDiscount_Type", "ItemSaleEventDiscountType",
    "Mounth", "YearOpen", "DayOfWeekOpen",
    "JurName", "Conception", "Store_Name", "Currencies_Currency",
    "Product_Type", "TransactionType", "Contr_Account_Group",
    "Contr_Product_TopParent", "Contr_Product_SecondParent", "Contr_Product_ThirdParent",
    "Product_MeasureUnit", "Product_TopParent", "Product_SecondParent", "Product_ThirdParent",
    "Account_CounteragentType", "Product_Category",
    "url",
}

# Preferred physical sort key per report type.
SORT_KEY_CANDIDATES = {
    "SALES": ["OpenDate_Typed", "Department", "DishGroup", "DishId"],
    "TRANSACTIONS": ["DateTime_DateTyped", "Department", "TransactionType"],
}

BASE_SUFFIX = "_RUB"


@dataclass(frozen=True)
class ReportTemplate:
    report_type: str
    group_by: tuple[str, ...]
    measures: tuple[str, ...]
    # measure (source name) -> sum | avg | min | max | count, or
    # ("ratio", numerator field, denominator field); default by name rule
    measure_kinds: dict = field(default_factory=dict)
    # the field that ``.Percent`` measures are a share of
    percent_of: str = "DishDiscountSumInt"

    @staticmethod
    def from_json(text: str | dict) -> "ReportTemplate":
        cfg = json.loads(text) if isinstance(text, str) else text
        return ReportTemplate(
            report_type=cfg.get("reportType", "SALES"),
            group_by=tuple(cfg.get("groupByRowFields", [])),
            measures=tuple(cfg.get("aggregateFields", [])),
        )

    @property
    def date_field(self) -> str:
        if self.report_type not in DATE_FIELDS:
            raise ValueError(f"unsupported report type: {self.report_type}")
        return DATE_FIELDS[self.report_type][1]

    @property
    def dimensions(self) -> list[str]:
        return [normalise_name(f) for f in self.group_by]

    @property
    def measure_columns(self) -> list[str]:
        return [normalise_name(f) for f in self.measures]

    def measure_spec(self, measure: str) -> tuple[str, str]:
        """[design] measure registry -> (kind, source column).

        An explicit kind wins; a ``.Avg`` suffix (or ``Average`` in the name)
        averages the field named without the suffix; a ``.Percent`` suffix is
        the sum of the field without it over the sum of ``percent_of``;
        anything else is a sum.
        """
        if measure in self.measure_kinds:
            return self.measure_kinds[measure], normalise_name(measure)
        lowered = measure.lower()
        if lowered.endswith(".avg"):
            return "avg", normalise_name(measure[: -len(".avg")])
        if lowered.endswith(".percent"):
            return ("ratio", measure[: -len(".percent")], self.percent_of), normalise_name(measure)
        if "average" in lowered:
            return "avg", normalise_name(measure)
        return "sum", normalise_name(measure)


def mart_schema(template: ReportTemplate, convert_currency: bool = True,
                measure_type: T.DataType = T.DoubleType()) -> T.StructType:
    """SCH-1: mart schema generated from a template.

    Precedence per dimension: numeric list, main date field, low-cardinality
    list, never-null list, nullable string. Every measure is a nullable
    number, followed by its base-currency copy when conversion is on; ``url``
    closes the schema. Measures default to double: single precision loses
    cents above about 167k and makes reconciliation inexact.
    """
    date_field = template.date_field
    dims = template.dimensions
    clash = set(dims) & set(template.measure_columns)
    if clash:
        raise ValueError(f"fields used as dimension and measure: {sorted(clash)}")
    fields: list[T.StructField] = []
    for name in dims:
        if name in NUMERIC_FIELDS:
            fields.append(T.StructField(name, measure_type, True))
        elif name == date_field:
            fields.append(T.StructField(name, T.DateType(), False))
        elif name in LOW_CARDINALITY_FIELDS or name in NON_NULLABLE_FIELDS:
            fields.append(T.StructField(name, T.StringType(), False))
        else:
            fields.append(T.StructField(name, T.StringType(), True))
    for name in template.measure_columns:
        fields.append(T.StructField(name, measure_type, True))
        if convert_currency:
            fields.append(T.StructField(name + BASE_SUFFIX, measure_type, True))
    if "url" not in [f.name for f in fields]:
        fields.append(T.StructField("url", T.StringType(), False))
    return T.StructType(fields)


def sort_key(template: ReportTemplate, schema: T.StructType) -> list[str]:
    """SRT-3: preferred key columns that exist in the schema, in order."""
    names = set(schema.fieldNames())
    preferred = SORT_KEY_CANDIDATES.get(template.report_type, [template.date_field])
    return [c for c in preferred if c in names]


def date_range_filter(date_col: str | Column, date_from: dt.date, date_to: dt.date) -> Column:
    """FLT-1: the report range is sent as [from, to + 1 day); half-open."""
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return (c >= F.lit(date_from)) & (c < F.lit(date_to + dt.timedelta(days=1)))


# 18 digits before the point and 10 behind it
EXACT_TYPE = "decimal(28,10)"


def _measure_expr(kind, name: str) -> Column:
    # Money is summed as exact decimals: the result does not depend on the
    # order in which partitions are combined, so retries and re-partitioning
    # give identical figures.
    # A group with a value that no decimal holds is summed as doubles, never
    # without that value.
    def total(column: str) -> Column:
        exact = F.col(column).try_cast(EXACT_TYPE)
        return F.when(F.count(exact) == F.count(F.col(column)), F.sum(exact).cast("double")).otherwise(F.sum(F.col(column).cast("double")))

    if isinstance(kind, tuple) and kind[0] == "ratio":
        num, den = total(normalise_name(kind[1])), total(normalise_name(kind[2]))
        return F.when(den != 0, num / den)
    if kind == "sum":
        return total(name)
    if kind == "avg":
        return total(name) / F.count(F.col(name)).cast("double")
    if kind == "min":
        return F.min(F.col(name)).cast("double")
    if kind == "max":
        return F.max(F.col(name)).cast("double")
    if kind == "count":
        return F.count(F.col(name))
    raise ValueError(f"unknown measure kind {kind}")


def run_report(rows: DataFrame, template: ReportTemplate,
               date_from: dt.date | None = None, date_to: dt.date | None = None) -> DataFrame:
    """AGG-1: group the report rows by the template dimensions.

    ``rows`` carries normalised column names. The date filter is applied
    before the aggregate so Catalyst pushes it into the scan.
    """
    if date_from is not None and date_to is not None:
        rows = rows.where(date_range_filter(template.date_field, date_from, date_to))
    aggs = []
    for source_name, col_name in zip(template.measures, template.measure_columns):
        kind, source_col = template.measure_spec(source_name)
        aggs.append(_measure_expr(kind, source_col).alias(col_name))
    return rows.groupBy(*template.dimensions).agg(*aggs)
