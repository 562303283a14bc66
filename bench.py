"""Time the headline jobs over whole tables; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickloom import build_session  # noqa: E402
from verify import queries  # noqa: E402

HEADLINE = [name for name in queries.QUERIES if name.startswith("m")]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:]
    names = [n for n in HEADLINE if not only or any(n.startswith(o) for o in only)]
    # One untimed scan starts the JVM's compiler.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey").count().write.format("noop").mode("overwrite").save()
    models = queries.Models(spark, sf_dir)
    seconds = {}
    start = time.time()
    for raw in (models.raw_issues, models.raw_comments, models.raw_changelog, models.raw_issuelinks, models.raw_parents):
        raw()
    seconds["land_raw_tables"] = round(time.time() - start, 3)
    for name in names:
        start = time.time()
        queries.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "total time of the ticket models", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
