"""Headline-query bench.

Runs the headline queries on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]``, forces each result through the ``noop`` sink,
and prints one JSON line with the median of five timed runs per query
(after one warm-up run). ``replace_range`` is timed on an existing mart:
the mart is built once, the idempotent replacement is what is measured.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pyspark  # noqa: E402

from salesmart.operators import mart, template  # noqa: E402
from salesmart.plans import params as P  # noqa: E402
from salesmart.plans import queries as Q  # noqa: E402
from salesmart.session import build_session  # noqa: E402
from salesmart.sources import fixtures, tables  # noqa: E402

HEADLINE = [
    "report_sales", "report_transactions", "fx_convert", "coerce_types", "load_summary",
    "multi_source_window", "outlet_stations", "weather_by_outlet", "latest_by_key",
]


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(fn, runs: int = 5) -> float:
    fn()  # warm-up
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus))
    spark = build_session(f"local[{cpus}]", partitions, app_name="salesmart-bench")
    spark.sparkContext.setLogLevel("ERROR")
    tables.spread_scans(cpus)  # the generated tables are one row group each
    reg = Q.registry()
    results: dict[str, float | None] = {}
    errors: dict[str, str] = {}

    def measure(key: str, fn) -> None:
        try:
            results[key] = round(_timed(fn), 3)
        except Exception as exc:  # keep measuring the others; report what failed
            results[key] = None
            errors[key] = f"{type(exc).__name__}: {str(exc)[:200]}"

    for key in HEADLINE:
        measure(key, lambda k=key: _force(reg[k](spark, data_dir)))

    # range replacement on a prepared mart
    def prepare():
        rows = fixtures.sales_raw(spark, data_dir)
        full = template.mart_schema(P.SALES_MART_TEMPLATE, convert_currency=False)
        spec = Q._mart_spec(spark, full, "bench-mart")
        mart.create_mart(spark, spec, rows)
        return spec, Q.replace_batch(rows)

    try:
        spec, batch = prepare()

        def replace():
            mart.replace_range(spark, spec, batch, P.REPLACE_FROM, P.REPLACE_TO)
            _force(mart.read_mart(spark, spec, P.REPLACE_FROM, P.REPLACE_TO))

        measure("replace_range", replace)
    except Exception as exc:
        results["replace_range"] = None
        errors["replace_range"] = f"{type(exc).__name__}: {str(exc)[:200]}"
    total = round(sum(v for v in results.values() if v is not None), 3)
    sf = os.path.basename(data_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_median_sec", "value": total, "unit": "sec",
        "queries": results, "sf": sf, "cpus": cpus, "shuffle_partitions": partitions,
        "spark": pyspark.__version__, **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
