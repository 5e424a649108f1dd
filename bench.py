"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. ``--all`` times every query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

from ledgerflow.queries import QUERIES
from ledgerflow.session import build_session, staging

HEADLINE = [
    "golden_record",
    "latest_per_key",
    "running_number",
    "multi_agg",
    "group_avg",
    "top_k",
    "join_dim",
    "incremental_new_rows",
    "recon_amount_diff",
    "duplicate_report",
    "settlement_by_merchant",
    "fee_summary",
    "conform_orders",
    "text_to_number",
    "date_mixed",
    "strip_accents",
    "hmac_token",
    "detokenise",
    "safe_dataset",
    "import_template",
    "import_encoding",
    "incremental_load",
    "report_import",
    "report_pack",
    "stream_json",
    "linreg_one_feature",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's readers and code generator before the clock.
    QUERIES["row_count"](spark, sf_dir).collect()
    names = [a for a in sys.argv[1:] if not a.startswith("-")] or HEADLINE
    if "--all" in sys.argv:
        names = list(QUERIES)
    times = {}
    for name in names:
        begin = time.perf_counter()
        with staging(spark):
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)
        if "--verbose" in sys.argv:
            print(name, times[name], file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
