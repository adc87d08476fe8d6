"""Landed lines of any shape: unknown fields, clashing names, lines that do not parse, and what a load reports."""

import datetime as dt
import json
import os

from pyspark.sql import types as T

from salesmart.operators import load, mart, normalize
from salesmart.session import work_dir
from salesmart.sources import landed

SCHEMA = T.StructType([T.StructField("OpenDate_Typed", T.DateType(), False), T.StructField("Department", T.StringType(), False),
                       T.StructField("DishSumInt", T.DoubleType()), T.StructField("url", T.StringType(), False)])
CHUNK = {"chunk_from": "2024-01-01", "chunk_to": "2024-01-07"}


def landing(spark, lines_by_source):
    root = work_dir(spark, "lines").removeprefix("file://")
    for source, lines in lines_by_source.items():
        os.makedirs(f"{root}/source={source}")
        with open(f"{root}/source={source}/part.json", "w", encoding="utf-8") as f:
            f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    return landed.read_report_records(spark, root)


LINES = {
    "src1": [{"OpenDate.Typed": "2024-01-02", "Department": "A", "DishSumInt": 5, **CHUNK},
             {"OpenDate.Typed": "2024-01-03", "Department": "B", "DishSumInt": "1 000,5", "Guest-Num": 2, "Extra.A": None, **CHUNK},
             "", "   ",
             {"OpenDate-Typed": "2024-01-01", "OpenDate.Typed": "2024-01-04", "Department": None, "Extra.A": {"x": [1]}, **CHUNK},
             {"OpenDate.Typed": "not a day", "Department": "C", **CHUNK},
             '{"OpenDate.Typed": "2024-01-05", "Depart', "[1, 2]", '"text"', "no json {"],
    "src2": [{"url": "elsewhere", "OpenDate.Typed": "2024-01-06T10:00:00", **CHUNK}, "{", "{}"],
}


def loaded(spark, lines, rejects=None, spec=None):
    spec = spec or mart.MartSpec(work_dir(spark, "load-test"), SCHEMA, "OpenDate_Typed")
    if not mart.mart_exists(spark, spec.path):
        mart.create_mart(spark, spec)
    report = load.load_landed(spark, landing(spark, lines), spec, [], spark.createDataFrame([], landed.RATES_SCHEMA),
                              dt.date(2024, 1, 1), dt.date(2024, 1, 7), rejects)
    return spec, report


def test_every_line_is_inserted_rejected_or_malformed(spark):
    rejects = work_dir(spark, "bad")
    spec, report = loaded(spark, LINES, rejects)
    rows = sorted((str(r["OpenDate_Typed"]), r["Department"], r["DishSumInt"], r["url"]) for r in mart.read_mart(spark, spec).collect())
    assert rows == [("2024-01-02", "A", 5.0, "http://src1"), ("2024-01-03", "B", 1000.5, "http://src1"),
                    ("2024-01-04", normalize.DEFAULT_TEXT, None, "http://src1"), ("2024-01-06", normalize.DEFAULT_TEXT, None, "http://src2")]
    assert report.totals == {"rows_in": 11, "inserted": 4, "rejected": 2, "malformed": 5, "unknown_values": 3}
    summary = report.summary.collect()
    assert {k: sum(r[k] for r in summary) for k in report.totals} == report.totals
    assert {(r["url"], str(r["chunk_from"])): (r["rows_in"], r["malformed"]) for r in summary} == {
        ("http://src1", "2024-01-01"): (4, 0), ("http://src1", "None"): (4, 4), ("http://src2", "2024-01-01"): (1, 0), ("http://src2", "None"): (2, 1)}
    assert {r["field_name"]: (r["n_rows"], r["n_sources"]) for r in report.unknown.collect()} == {"Guest-Num": (1, 1), "Extra.A": (2, 1)}
    dead = [json.loads(r["value"]) for r in spark.read.option("recursiveFileLookup", True).text(rejects).collect()]
    broken = sorted(d["raw"] for d in dead if d["error"] == normalize.MALFORMED)
    assert broken == sorted(['{"OpenDate.Typed": "2024-01-05", "Depart', "[1, 2]", '"text"', "no json {", "{"])
    assert all("record" not in d and "/source=src" in d["file"] for d in dead if d["error"] == normalize.MALFORMED)
    unfit = [d for d in dead if d["error"] != normalize.MALFORMED]
    assert sorted(json.loads(d["record"])["Department"] for d in unfit) == ["C", normalize.DEFAULT_TEXT] and all(d["raw"] for d in unfit)


def test_a_second_load_of_the_same_lines_changes_nothing(spark):
    spec, _ = loaded(spark, LINES)
    before = sorted(map(str, mart.read_mart(spark, spec).collect()))
    loaded(spark, LINES, spec=spec)
    assert sorted(map(str, mart.read_mart(spark, spec).collect())) == before


def test_nothing_landed(spark):
    spec, report = loaded(spark, {"src1": [""]})
    assert mart.read_mart(spark, spec).count() == 0 and report.totals["rows_in"] == 0 and report.summary.count() == 0
