"""The stored keyed table: merge on read, refresh by range, compaction by bucket."""

import datetime as dt
import os

from pyspark.sql import functions as F

from salesmart.operators import keyed
from salesmart.session import work_dir

SCHEMA = "org_id string, date date, temp double"


def table(spark, schema=SCHEMA, key=("org_id", "date"), version=(), buckets=4):
    empty = spark.createDataFrame([], schema)
    return keyed.KeyedTable(work_dir(spark, "keyed"), empty.schema, key, version, buckets)


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def day(n):
    return dt.date(2024, 1, n)


def stored(spark, t):
    return {(r["org_id"], r["date"].day): r["temp"] for r in keyed.read(spark, t).collect()}


def files(t):
    root = t.path.removeprefix("file://")
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_later_syncs_win_and_untouched_buckets_keep_their_files(spark):
    t = table(spark, buckets=16)
    assert keyed.read(spark, t).count() == 0 and keyed.compact(spark, t) == []
    base = {(f"o{k}", 1 + k % 3): float(k) for k in range(60)}
    keyed.sync(spark, t, frame(spark, [(o, day(d), v) for (o, d), v in base.items()]))
    assert len(keyed.compact(spark, t)) > 4 and stored(spark, t) == base
    before = files(t)
    keyed.sync(spark, t, frame(spark, [("o1", day(2), 100.0), ("new", day(5), 5.0)]))
    want = base | {("o1", 2): 100.0, ("new", 5): 5.0}
    assert stored(spark, t) == want
    changed = keyed.compact(spark, t)
    assert 1 <= len(changed) <= 2 and stored(spark, t) == want
    assert before <= files(t)
    assert keyed.clean(spark, t) and stored(spark, t) == want
    kept = {f for f in before if "/base/" in f and int(f.split("bucket=")[1].split("/")[0]) not in changed}
    assert kept and kept <= files(t)


def test_compaction_waits_for_enough_syncs(spark):
    t = table(spark, buckets=1)
    for k in range(3):
        keyed.sync(spark, t, frame(spark, [("a", day(1), float(k))]))
        assert keyed.compact(spark, t, min_syncs=3) == ([0] if k == 2 else [])
        assert stored(spark, t) == {("a", 1): float(k)}


def test_refresh_replaces_the_range_of_refreshed_entities(spark):
    t = table(spark)
    rows = [(o, day(d), d + 0.5) for o in ("a", "b") for d in range(1, 10)]
    keyed.sync(spark, t, frame(spark, rows))
    keyed.refresh(spark, t, frame(spark, [("a", day(4), 44.0), ("a", day(20), 1.0), ("c", day(5), 55.0)]), day(3), day(6))
    want = {(o, d.day): v for o, d, v in rows if not (o == "a" and 3 <= d.day <= 6)} | {("a", 4): 44.0, ("c", 5): 55.0}
    for _ in range(2):
        assert stored(spark, t) == want
        keyed.compact(spark, t)
        keyed.clean(spark, t)
    keyed.refresh(spark, t, frame(spark, [("a", day(3), 33.0)]), day(3), day(6))
    assert stored(spark, t) == {k: v for k, v in want.items() if k != ("a", 4)} | {("a", 3): 33.0}


def test_versions_order_before_syncs(spark):
    schema = "org_id string, name string, synced_at int"
    t = table(spark, schema, ("org_id",), ("synced_at",), buckets=2)
    keyed.sync(spark, t, frame(spark, [("a", "newest", 9), ("b", "first", 1), (None, "no id", 1)], schema))
    keyed.compact(spark, t)
    keyed.sync(spark, t, frame(spark, [("a", "late but old", 3), ("b", "tie", 1), ("b", "older", 0)], schema))
    assert {r["org_id"]: r["name"] for r in keyed.read(spark, t).collect()} == {"a": "newest", "b": "tie", None: "no id"}


def test_a_failed_sync_does_not_count(spark):
    t = table(spark)
    keyed.sync(spark, t, frame(spark, [("a", day(1), 1.0)]))
    bad = frame(spark, [("a", day(1), 2.0)]).withColumn("temp", F.expr("raise_error('stopped')").cast("double"))
    try:
        keyed.sync(spark, t, bad)
        raise AssertionError("the sync must fail")
    except Exception as e:
        assert "stopped" in str(e)
    assert stored(spark, t) == {("a", 1): 1.0}
    keyed.sync(spark, t, frame(spark, [("a", day(1), 3.0)]))
    assert stored(spark, t) == {("a", 1): 3.0}
