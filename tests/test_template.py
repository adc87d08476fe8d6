"""Template schema generation and the report aggregation."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from salesmart.operators import template as TM


def test_schema_from_template():
    t = TM.ReportTemplate.from_json({
        "reportType": "SALES",
        "groupByRowFields": ["OpenDate.Typed", "Department", "GuestNum", "DishName", "UniqOrderId.Id"],
        "aggregateFields": ["DishSumInt", "DishDiscountSumInt"],
    })
    schema = TM.mart_schema(t)
    f = {x.name: x for x in schema.fields}
    assert schema.fieldNames() == ["OpenDate_Typed", "Department", "GuestNum", "DishName", "UniqOrderId_Id",
                                   "DishSumInt", "DishSumInt_RUB", "DishDiscountSumInt", "DishDiscountSumInt_RUB", "url"]
    assert isinstance(f["OpenDate_Typed"].dataType, T.DateType) and not f["OpenDate_Typed"].nullable
    assert isinstance(f["GuestNum"].dataType, T.DoubleType) and f["GuestNum"].nullable
    assert not f["Department"].nullable and f["DishName"].nullable and not f["UniqOrderId_Id"].nullable
    assert TM.sort_key(t, schema) == ["OpenDate_Typed", "Department"]
    assert "DishSumInt_RUB" not in TM.mart_schema(t, convert_currency=False).fieldNames()


def test_bad_templates():
    with pytest.raises(ValueError):
        TM.mart_schema(TM.ReportTemplate("STOCK", ("Date",), ("Amount",)))
    with pytest.raises(ValueError):
        TM.mart_schema(TM.ReportTemplate("SALES", ("OpenDate.Typed", "GuestNum"), ("GuestNum",)))


def test_report_measures(spark):
    rows = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "a", 10.0, 1.0), (dt.date(2024, 1, 1), "a", 30.0, 3.0),
         (dt.date(2024, 1, 2), "a", 5.0, None), (dt.date(2024, 1, 3), "b", 7.0, 7.0)],
        "OpenDate_Typed date, Department string, DishSumInt double, Disc double")
    t = TM.ReportTemplate("SALES", ("OpenDate.Typed", "Department"),
                          ("DishSumInt", "DishSumInt.Avg", "Disc.Share"),
                          measure_kinds={"Disc.Share": ("ratio", "Disc", "DishSumInt")})
    out = {(r["OpenDate_Typed"], r["Department"]): r
           for r in TM.run_report(rows, t, dt.date(2024, 1, 1), dt.date(2024, 1, 2)).collect()}
    assert set(out) == {(dt.date(2024, 1, 1), "a"), (dt.date(2024, 1, 2), "a")}   # half-open end: to + 1 day
    r = out[(dt.date(2024, 1, 1), "a")]
    assert r["DishSumInt"] == 40.0 and r["DishSumInt_Avg"] == 20.0 and r["Disc_Share"] == 0.1
