"""Benchmark: headline jobs over the driver's tables.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line. Every job is forced to
completion with the ``noop`` sink (full computation, nothing collected to
the driver), except ``snapshot_publish`` which writes the seven zstd
Parquet tables and the aggregates to a fresh folder under the shared
checkpoint directory, gated like a real publish.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans import catalog, snapshot  # noqa: E402
from quarry.plans import adapters as AD  # noqa: E402
from quarry.session import checkpoint_root, get_spark  # noqa: E402
from quarry.sources import sinks  # noqa: E402

HEADLINE = [
    # snapshot transform: nested documents -> detail tables and aggregates
    "items", "skills", "passives", "item_mods", "class_distribution", "keystone_usage",
    # state / roster
    "seed_state", "merge_results", "attempt_results", "merge_ladder",
    # storage / requests / economy / gates
    "trim_plan", "usage_by_category", "response_categories", "quota_audit", "danger_streaks",
    "economy_report", "tree_coverage", "snapshot_gate",
]


def run(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # Local mode: the driver heap is all the memory the jobs get (default 1 GB).
    memory = os.environ.get("BENCH_DRIVER_MEMORY", "4g")
    spark = get_spark(f"local[{cpus}]", app="quarry-bench", shuffle_partitions=int(cpus) * 2,
                      driver_memory=memory)
    spark.sparkContext.setLogLevel("ERROR")
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    times: dict[str, float] = {}

    # warm-up: JVM, parquet footers
    AD.table(spark, sf_dir, "orders").write.format("noop").mode("overwrite").save()

    # The state documents (the reference's input file) are built once from
    # the flat tables and staged as gz NDJSON; the transform jobs scan them.
    times["build_state_documents"] = run(lambda: snapshot.staged_state(spark, sf_dir))

    for name in HEADLINE:
        q = catalog.QUERIES[name]
        times[name] = run(lambda: q(spark, sf_dir).write.format("noop").mode("overwrite").save())

    def publish():
        norm = snapshot.from_tables(spark, sf_dir)
        state = snapshot.identity_state(spark, sf_dir)
        manifest_total = snapshot.claimed_total(spark, sf_dir).first()["total_characters"]
        out = checkpoint_root(spark, "bench-publish", unique=True)
        gate = sinks.publish_snapshot(norm, sinks.tally_for(state), out, "Standard", catalog.NOW_1,
                                      now=catalog.NOW_2, total_characters=manifest_total)
        if not gate["ok_to_publish"]:
            raise SystemExit(f"the gate refused the bench's snapshot: {gate['errors']}")

    times["snapshot_publish"] = run(publish)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
