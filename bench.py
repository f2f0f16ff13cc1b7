"""Benchmark the headline queries.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8),
BENCH_SHUFFLE=1 to add shuffle bytes per query (from the event log).
Each query is executed into Spark's ``noop`` sink (full execution, no driver
transfer). A first pass warms the JVM and the codegen cache ("cold"); before
the second pass ("warm", the reported value) every cache of written tables is
cleared, and the core layer is written again as ``build_layers`` and the nested
summary as ``build_summary``. Queries then read those written tables.
Prints exactly one JSON line.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "monthly_metrics",
    "rolling_12m_spine",
    "denominator_exclusions",
    "numerator_patients",
    "exclusion_reasons",
    "discharge_summary_flat",
    "fct_discharge",
    "fct_diagnosis",
    "effective_dated_lookup",
    "upsert_latest",
    "dq_row_counts",
    "dq_pk_unique",
    "dq_fk_orphans",
    "dq_unknown_share",
    "dq_principal",
    "dq_dates",
    "dq_nulls",
    "dq_metric_bounds",
    "dq_mom_change",
    "dq_freshness",
    "dq_reconcile",
    "dq_parse",
    "stream_staged_upsert",
    "nightly_metrics",
    "interval_lookup",
    "fct_diagnosis_versioned",
    "discharge_summary_versioned",
    "upsert_touched",
    "dq_reconcile_contents",
]


def shuffle_bytes(event_dir: str) -> dict[str, int]:
    """Shuffle bytes written per job group, from the Spark event log."""
    stage_group: dict[int, str] = {}
    written: dict[str, int] = {}
    for f in sorted(glob.glob(f"{event_dir}/**/events*", recursive=True)):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                group = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e["Stage IDs"]:
                    stage_group[sid] = group
            elif e["Event"] == "SparkListenerTaskEnd":
                group = stage_group.get(e["Stage ID"])
                m = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                if group:
                    written[group] = written.get(group, 0) + int(m.get("Shuffle Bytes Written", 0))
    return written


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from indicata.session import build_session

    # Shuffle accounting reads Spark's event log; it is opt-in because the
    # event log itself costs time on every task.
    measure_shuffle = os.environ.get("BENCH_SHUFFLE", "0") == "1"
    event_dir = tempfile.mkdtemp(prefix="indicata-bench-events-") if measure_shuffle else ""
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir} if measure_shuffle else {}
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, **extra)
    from indicata.plans import catalog

    def run(name: str, group: str | None = None) -> float:
        if group:
            spark.sparkContext.setJobGroup(group, group)
        t = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.mode("overwrite").format("noop").save()
        return time.perf_counter() - t

    def build_layers() -> float:
        """Reference and core layers written once (as the nightly run does)."""
        t = time.perf_counter()
        w = catalog.warehouse(spark, sf_dir)
        _ = (w.code_map, w.dim_code, w.bridge, w.code_identifiers, w.flags(catalog.SPEC))
        _ = (w.fct_discharge_by_month, w.fct_diagnosis, w.fct_procedure)
        return time.perf_counter() - t

    def build_summary() -> float:
        t = time.perf_counter()
        _ = catalog.warehouse(spark, sf_dir).discharge_summary
        return time.perf_counter() - t

    layers_cold, summary_cold = build_layers(), build_summary()

    cold = {n: round(run(n), 3) for n in HEADLINE}
    # Warm pass: every cache of written tables is cleared, so layers, versions
    # and nights are written again; only JVM/codegen warm-up is shared.
    for cache in (catalog._WAREHOUSES, catalog._HOT_WAREHOUSES, catalog._VERSIONED, catalog._VERSIONED_DIMS, catalog._REFERENCES, catalog._NIGHTS, catalog._BACKFILLS):
        cache.clear()
    layers_warm, summary_warm = build_layers(), build_summary()
    warm = {n: round(run(n, f"warm:{n}"), 3) for n in HEADLINE}
    queries = {"build_layers": round(layers_warm, 3), "build_summary": round(summary_warm, 3), **warm}
    spark.stop()
    written = shuffle_bytes(event_dir) if measure_shuffle else {}
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_warm",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "cold": {"build_layers": round(layers_cold, 3), "build_summary": round(summary_cold, 3), **cold},
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                **({"shuffle_bytes_warm": {n: written.get(f"warm:{n}", 0) for n in HEADLINE}} if measure_shuffle else {}),
            }
        )
    )


if __name__ == "__main__":
    main()
