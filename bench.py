"""Headline queries at one scale; prints one JSON line.

Every query is materialised into the ``noop`` sink. The value is the sum of the
per-query medians. ``$BENCH_SF_DIR`` and ``$BENCH_CPUS`` choose data and cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sedimenta.operators.gold import build_gold  # noqa: E402
from sedimenta.operators.quality import check_and_enrich, check_orders  # noqa: E402
from sedimenta.operators.silver import silver_projection  # noqa: E402
from sedimenta.plans.queries import QUERIES  # noqa: E402
from sedimenta.session import build_session  # noqa: E402
from sedimenta.sources.adapters import raw_frames  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = [
    "dq_flagged", "dq_reason_counts", "dq_rule_totals", "silver_fato_vendas", "gold_uf_categoria", "gold_top10",
    "gate_reconciliation", "audit_quarantine_sample", "audit_silver_validity", "audit_silver_orphans",
    "audit_silver_vs_gold", "orphan_detail_left_anti", "roundtrip_raw_csv", "published_gold", "audit_files",
]


def _shuffled_silver(spark, sf_dir):
    raw = raw_frames(spark, sf_dir)
    checked = check_and_enrich(raw.pedidos, raw.clientes, raw.produtos, broadcast_limit=-1)
    return silver_projection(checked.valid(with_attributes=True), "linha")


def _shuffled_flagged(spark, sf_dir):
    raw = raw_frames(spark, sf_dir)
    return check_orders(raw.pedidos, raw.clientes, raw.produtos, broadcast_limit=-1).flagged()


# The same work with both dimensions taken as too large to broadcast.
SHUFFLED = {
    "dq_flagged_no_broadcast": _shuffled_flagged,
    "silver_fato_vendas_no_broadcast": _shuffled_silver,
    "gold_uf_categoria_no_broadcast": lambda spark, sf_dir: build_gold(_shuffled_silver(spark, sf_dir)),
}


def seconds(spark, query) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def timed(spark, queries: dict) -> dict[str, list[float]]:
    """All queries in turn, once to warm the session and then ``RUNS`` times, so order favours none of them."""
    runs = {name: [] for name in queries}
    for number in range(RUNS + 1):
        for name, query in queries.items():
            took = seconds(spark, query)
            if number:
                runs[name].append(round(took, 3))
    return runs


def main() -> None:
    size = sum(f.stat().st_size for f in Path(SF_DIR).glob("*.parquet"))
    spark = build_session("bench", f"local[{CPUS}]", size, {
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    runs = timed(spark, {name: QUERIES[name] for name in HEADLINE})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    shuffled = timed(spark, SHUFFLED)
    medians = {name: round(statistics.median(r), 3) for name, r in {**runs, **shuffled}.items()}

    print(json.dumps({
        "metric": "sum of median query times", "value": round(sum(medians[n] for n in runs), 3), "unit": "sec",
        "queries": medians, "sf": Path(SF_DIR).name.removeprefix("sf"),
        "cpus": CPUS, "spark": spark.version, "runs": RUNS,
        "spread": {name: [min(r), max(r)] for name, r in {**runs, **shuffled}.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
