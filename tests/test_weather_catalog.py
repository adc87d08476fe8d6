"""Weather responses, outlet defaults, config files and naming rules."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from salesmart.functions import names
from salesmart.operators import catalog, weather, windows
from salesmart.session import work_dir


def test_weather_size_rule(spark):
    day = ["2024-01-01", "2024-01-02"]
    full = {v: [1.0, 2.0] for v in weather.WEATHER_FIELDS}
    short = dict(full, wind_speed_10m_max=[1.0])
    longer = dict(full, cloud_cover_mean=[5.0, 6.0, 7.0])
    one_day = {v: [1.0] for v in weather.WEATHER_FIELDS if v != "precipitation_sum"}
    docs = [
        {"k": 1, "daily": dict(full, time=day)},
        {"k": 2, "daily": dict(short, time=day)},
        {"k": 3, "daily": dict(longer, time=day)},
        {"k": 4, "daily": dict(one_day, time=day[:1])},
        {"k": 5, "daily": dict({v: a for v, a in full.items() if v != "temperature_2m_min"}, time=day)},
    ]
    path = work_dir(spark, "weather-json")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "r.json"), "w") as f:
        for d in docs:
            f.write(json.dumps(d) + "\n")
    df = spark.read.json(path)
    out = weather.explode_weather(df, ["k"]).collect()
    by_k = {}
    for r in out:
        by_k.setdefault(r["k"], []).append(r)
    assert sorted(by_k) == [1, 3, 4]
    assert len(by_k[3]) == 2 and by_k[3][1]["cloud_cover_pct"] == 6.0
    assert by_k[4][0]["precipitation_mm"] is None


def test_outlet_defaults(spark):
    rows = [("o1", "  A  ", None, None, " RU ", 0.0, 37.5, None, None, None, None),
            ("o2", "B", 7, "x", None, 55.1, None, 123, "GEL", "Courier", 8)]
    df = spark.createDataFrame(rows, "id string, name string, code int, restaurantAddress string, country string, "
                                     "latitude double, longitude double, inn long, currencyIsoName string, "
                                     "deliveryServiceType string, version int")
    out = {r["org_id"]: r for r in weather.outlet_reference(df.withColumn("k", F.lit("abcdefghijkl")), "k").collect()}
    assert out["o1"]["org_name"] == "A" and out["o1"]["country"] == "RU" and out["o1"]["lat"] is None
    assert out["o1"]["lon"] == 37.5 and out["o1"]["currency"] == "RUB" and out["o1"]["org_code"] == ""
    assert out["o2"]["org_code"] == "7" and out["o2"]["lon"] is None and out["o2"]["pos_version"] == "8"
    assert out["o2"]["api_key_hint"] == "abcdefgh..."


def test_replace_weather_keeps_outlets_without_data(spark):
    schema = "date date, org_id string, temp_avg double"
    d = dt.date
    old = spark.createDataFrame([(d(2024, 1, 1), "a", 1.0), (d(2024, 1, 5), "a", 1.0), (d(2024, 1, 5), "b", 1.0)], schema)
    new = spark.createDataFrame([(d(2024, 1, 6), "a", 2.0)], schema)
    got = sorted(tuple(r) for r in weather.replace_weather(old, new, d(2024, 1, 3), d(2024, 1, 10)).collect())
    assert got == [(d(2024, 1, 1), "a", 1.0), (d(2024, 1, 5), "b", 1.0), (d(2024, 1, 6), "a", 2.0)]


def test_config_dir(spark):
    root = work_dir(spark, "configs")
    good = {catalog.CONFIG_SOURCE_KEY: {"api_url": "h", "login": "u", "password": "p"},
            catalog.CONFIG_TARGET_KEY: {"host": "c"}, catalog.CONFIG_TEMPLATE_KEY: {"reportType": "SALES"}}
    files = {
        "shop_pl1.json": good,
        "north/cafe_pl2.json": good,
        "plain.json": good,
        "bad.json": "{not json",
        "partial.json": {catalog.CONFIG_SOURCE_KEY: {}},
        "templates/x_pl3.json": good,
        "fields_pl4.json": good,
    }
    for rel, body in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            f.write(body if isinstance(body, str) else json.dumps(body))
    out = {r["relative_path"]: r for r in catalog.read_config_dir(spark, root).collect()}
    assert sorted(out) == ["north/cafe_pl2.json", "plain.json", "shop_pl1.json"]
    assert out["shop_pl1.json"]["template_name"] == "pl1" and out["shop_pl1.json"]["dataset_name"] == "shop.pl1"
    assert out["north/cafe_pl2.json"]["dataset_name"] == "north.cafe.pl2"
    assert out["plain.json"]["template_name"] == "plain"
    for rel, body in {"empty.json": "", "blank.json": " \n", "notes.txt": "x", "config.json": json.dumps(good), "long.json": json.dumps(good) + " " * 900, "list.json": "[1]"}.items():
        with open(os.path.join(root, rel), "w") as f:
            f.write(body)
    why = {r["relative_path"]: r["skip_reason"] for r in catalog.config_files(spark, root, max_bytes=800).collect()}
    assert why == {"shop_pl1.json": None, "north/cafe_pl2.json": None, "plain.json": None, "bad.json": "not json",
                   "partial.json": f"lacks {catalog.CONFIG_TARGET_KEY}", "templates/x_pl3.json": "excluded folder", "fields_pl4.json": "excluded path",
                   "blank.json": "not json", "notes.txt": "name", "config.json": "excluded path", "long.json": "too large", "list.json": "not json"}


def test_configs_in_folders_named_by_spark(spark):
    root = work_dir(spark, "configs")
    doc = json.dumps({catalog.CONFIG_SOURCE_KEY: {"api_url": "h"}, catalog.CONFIG_TARGET_KEY: {"host": "c"}, catalog.CONFIG_TEMPLATE_KEY: {}}, indent=1)
    rows = spark.createDataFrame([("a:b", "x_100%.json", doc), ("n", "y z.json", doc)], "folder string, document string, value string")
    rows.write.partitionBy("folder", "document").text(root)
    for at in (root, f"file:{root}", f"file://{root}/"):
        got = {(r["relative_path"], r["template_name"], r["skip_reason"]) for r in catalog.config_files(spark, at).collect()}
        assert got == {("a:b/x_100%.json", "100%", None), ("n/y z.json", "y z", None)}


def test_name_helpers(spark):
    assert names.normalise_name("OpenDate.Typed") == "OpenDate_Typed"
    assert names.split_dataset_name("db.table.x") == ("db", "table.x")
    assert names.with_scheme("host:8080") == "http://host:8080"
    assert names.with_scheme("https://h") == "https://h"
    import hashlib
    row = spark.createDataFrame([("a", "b")], "x string, y string").select(names.surrogate_key("x", "y").alias("k")).first()
    assert row["k"] == hashlib.sha256(b"a|b").hexdigest()[:16]


def test_windows(spark):
    assert windows.split_at(dt.date(2024, 1, 20), dt.date(2024, 1, 1), dt.date(2024, 1, 30)) == [
        ("history", dt.date(2024, 1, 1), dt.date(2024, 1, 19)), ("forecast", dt.date(2024, 1, 20), dt.date(2024, 1, 30))]
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 16)), (dt.date(2024, 1, 5), dt.date(2024, 1, 4))],
                               "date_from date, date_to date")
    out = [(r["chunk_from"], r["chunk_to"]) for r in windows.explode_chunks(df, 7).collect()]
    assert out == [(dt.date(2024, 1, 1), dt.date(2024, 1, 7)), (dt.date(2024, 1, 8), dt.date(2024, 1, 14)),
                   (dt.date(2024, 1, 15), dt.date(2024, 1, 16))]


def test_duplicates_stay_whole_records(spark):
    keys = "host string, login string, name string, note string"
    inc = spark.createDataFrame([("h", "u", "zzz", "a"), ("h", "u", "aaa", "z")], keys)
    none = spark.createDataFrame([], keys)
    assert [tuple(r) for r in catalog.insert_if_absent(none, inc, ["host", "login"]).collect()] == [("h", "u", "aaa", "z")]
    old = spark.createDataFrame([("k", 0, 0)], "k string, a int, b int")
    new = spark.createDataFrame([("k", 1, 9), ("k", 9, 1)], "k string, a int, b int")
    assert [tuple(r) for r in catalog.upsert(old, new, ["k"], ["a", "b"]).collect()] == [("k", 9, 1)]


def test_percent_is_a_ratio_of_sums(spark):
    from salesmart.operators.template import ReportTemplate, run_report
    t = ReportTemplate("SALES", ("Department",), ("ProductCostBase.Percent", "DishSumInt"))
    rows = spark.createDataFrame([("x", 10.0, 100.0, 2e14), ("x", 30.0, 60.0, 5.0), ("y", 1.0, 0.0, 1e30)],
                                 "Department string, ProductCostBase double, DishDiscountSumInt double, DishSumInt double")
    got = {r["Department"]: (r["ProductCostBase_Percent"], r["DishSumInt"]) for r in run_report(rows, t).collect()}
    assert got == {"x": (0.25, 2e14 + 5.0), "y": (None, 1e30)}


def test_upsert_and_weather_window(spark):
    old = spark.createDataFrame([("n1", "u1", "p1"), ("n2", "u2", "p2")], "name string, login string, password string")
    new = spark.createDataFrame([("n2", "u2b", "p2b"), ("n3", "u3", "p3")], "name string, login string, password string")
    got = sorted(tuple(r) for r in catalog.upsert(old, new, ["name"], ["login", "password"]).collect())
    assert got == [
        ("n1", "u1", "p1"), ("n2", "u2b", "p2b"), ("n3", "u3", "p3")]
    assert windows.weather_window(dt.date(2024, 1, 31)) == (dt.date(2024, 1, 1), dt.date(2024, 2, 7))


def test_landed_readers(spark):
    from salesmart.sources import landed
    root = work_dir(spark, "landed")
    os.makedirs(os.path.join(root, "docs"), exist_ok=True)
    with open(os.path.join(root, "docs", "r.json"), "w") as f:
        json.dump({"data": [{"OpenDate.Typed": "2024-01-05", "DishSumInt": "1 234,5"},
                            {"OpenDate.Typed": "2024-01-06", "DishSumInt": "7"}]}, f, indent=2)
    os.makedirs(os.path.join(root, "orgs"), exist_ok=True)
    with open(os.path.join(root, "orgs", "o.json"), "w") as f:
        json.dump({"organizations": [{"id": "a", "name": " A ", "latitude": 55.1, "longitude": 0}]}, f, indent=2)
    rows = landed.read_report_documents(spark, os.path.join(root, "docs"), ["OpenDate.Typed", "DishSumInt"]).collect()
    assert [r["DishSumInt"] for r in rows] == ["1 234,5", "7"]
    orgs = weather.outlet_reference(landed.read_outlet_responses(spark, os.path.join(root, "orgs"))).collect()
    assert orgs[0]["org_name"] == "A" and orgs[0]["lon"] is None and orgs[0]["lat"] == 55.1
    os.makedirs(os.path.join(root, "lines", "source_id=7"))
    with open(os.path.join(root, "lines", "source_id=7", "o.json"), "w") as f:
        f.write('{"organizations": [{"id": "a"}, {"id": "b"}]}\n{"organizations": []}\n{"organiz\n{"organizations": [{"id": "c", "new": 1}]}\n')
    by_line = landed.read_outlet_responses(spark, os.path.join(root, "lines"), lines=True).collect()
    assert sorted((r["source_id"], r["id"]) for r in by_line) == [(7, "a"), (7, "b"), (7, "c")]


def test_task_configs_drop_incomplete_and_inactive(spark):
    tasks = spark.createDataFrame(
        [("t1", "a", 1, 1, 1, True, 3, 0), ("t2", "b", 1, 9, 1, True, 3, 0), ("t3", "c", 1, 1, 1, False, 3, 0)],
        "id string, name string, source_id int, target_id int, template_id int, is_active boolean, "
        "days_offset_start int, days_offset_end int")
    sources = spark.createDataFrame([(1, "src1", "RUB")], "id int, api_url string, currency string")
    targets = spark.createDataFrame([(1,)], "id int")
    templates = spark.createDataFrame([(1, "pl1")], "id int, name string")
    cfg = windows.task_configs(tasks, sources, targets, templates)
    rows = cfg.collect()
    assert [r["id"] for r in rows] == ["t1"] and rows[0]["source_url"] == "http://src1"
    w = windows.task_window(cfg, dt.date(2024, 1, 10)).first()
    assert (w["date_from"], w["date_to"]) == (dt.date(2024, 1, 7), dt.date(2024, 1, 10))


def test_search_forms(spark):
    df = spark.createDataFrame([("Cafe_North",), ("CafeXNorth",), ("cafe north",)], "name string")
    lit = {r["name"] for r in df.where(catalog.contains_ci("name", "CAFE_")).collect()}
    pat = {r["name"] for r in df.where(catalog.like_ci("name", "CAFE_")).collect()}
    assert lit == {"Cafe_North"}
    assert pat == {"Cafe_North", "CafeXNorth", "cafe north"}
    slashed = spark.createDataFrame([("a\\b",), ("ab\\",), ("ab",)], "name string")
    assert [r["name"] for r in slashed.where(catalog.like_ci("name", "A\\B")).collect()] == ["a\\b"]
    assert [r["name"] for r in slashed.where(catalog.like_ci("name", "b\\")).collect()] == ["ab\\"]


def test_window_coverage_against_every_window(spark):
    """Overlapping, touching, nested, single-day and reversed windows; a source without rows, rows without a window."""
    as_of = dt.date(2024, 1, 31)
    offsets = [(10, 5), (10, 5), (8, 2), (4, 4), (3, 1), (1, 3), (30, 29), (12, 11)]
    tasks = [(f"t{i}", f"http://s{i % 3}", a, b) for i, (a, b) in enumerate(offsets)]
    cfg = spark.createDataFrame(tasks, "id string, source_url string, days_offset_start int, days_offset_end int")
    want = {}
    for _, url, a, b in tasks:
        for d in range(b, a + 1):
            key = (url, as_of - dt.timedelta(days=d))
            want[key] = want.get(key, 0) + 1
    assert {(r["source_url"], r["day"]): r["n_tasks"] for r in windows.coverage(cfg, as_of).collect()} == want
    facts = [(f"http://s{k % 4}", as_of - dt.timedelta(days=k % 35), k) for k in range(200)]
    rows = spark.createDataFrame(facts, "url string, day date, k int")
    got = sorted((r["k"], r["n_tasks"]) for r in windows.rows_in_task_windows(cfg, rows, as_of, "day").collect())
    assert got == sorted((k, want[url, day]) for url, day, k in facts if (url, day) in want)
    assert windows.rows_in_task_windows(cfg.where("id = 't5'"), rows, as_of, "day").collect() == []
    assert windows.rows_in_task_windows(cfg.limit(0), rows, as_of, "day").columns == ["url", "day", "k", "n_tasks"]
