"""Physical-plan summary of the registered queries (``python -m tallyhouse.plans.report``).

For each query: hash shuffles, single-partition exchanges, broadcasts, join
strategies, windows, sort-based aggregates, and whether every Parquet scan reads
a pruned schema.  Single-partition exchanges are expected only where the input
is bounded (final merge of global aggregates, the store window after
``distinct``, the key-offset and nightly windows over days).
"""

from __future__ import annotations

import re
import sys

COLUMNS = ("hash_shuffles", "single_partition", "broadcasts", "broadcast_joins",
           "sort_merge_joins", "windows", "sort_aggregates", "scans", "max_scan_columns",
           "scans_with_pushed_filters")


def plan_text(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted")


def node_blocks(text: str) -> list[tuple[str, str]]:
    """(node name, detail text) for each ``(n) Name`` block of a formatted plan."""
    parts = re.split(r"^\((\d+)\) ", text, flags=re.M)
    blocks = []
    for i in range(2, len(parts), 2):
        body = parts[i]
        name = body.splitlines()[0].strip()
        blocks.append((name, body))
    return blocks


def summarize(df) -> dict:
    out = dict.fromkeys(COLUMNS, 0)
    for name, body in node_blocks(plan_text(df)):
        if name.startswith("Exchange"):
            if "SinglePartition" in body:
                out["single_partition"] += 1
            else:
                out["hash_shuffles"] += 1
        elif name.startswith("BroadcastExchange"):
            out["broadcasts"] += 1
        elif name.startswith("BroadcastHashJoin"):
            out["broadcast_joins"] += 1
        elif name.startswith("SortMergeJoin"):
            out["sort_merge_joins"] += 1
        elif name.startswith("Window"):
            out["windows"] += 1
        elif name.startswith("SortAggregate"):
            out["sort_aggregates"] += 1
        elif name.startswith("Scan parquet"):
            out["scans"] += 1
            m = re.search(r"ReadSchema: struct<(.*)>", body)
            if m:
                out["max_scan_columns"] = max(out["max_scan_columns"], m.group(1).count(":"))
            if re.search(r"PushedFilters: \[[^\]]+\]", body):
                out["scans_with_pushed_filters"] += 1
    return out


def main(sf_dir: str = "/root/testdata/sf0.1", names: list[str] | None = None) -> None:
    from tallyhouse import catalog
    from tallyhouse.session import build_session
    spark = build_session("local[8]", shuffle_partitions=16)
    q = catalog.queries()
    names = names or ["revenue_reconciliation", "orders_deduplicated", "products_resolved",
                      "dim_date", "dim_store", "fact_order_lines", "fact_settlements",
                      "daily_revenue", "revenue_by_category", "orphan_products",
                      "late_refunds", "duplicate_orders", "nightly_gate"]
    cols = list(COLUMNS)
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for n in names:
        s = summarize(q[n](spark, sf_dir))
        print(f"| {n} | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main(*(sys.argv[1:2] or []), names=sys.argv[2:] or None)
