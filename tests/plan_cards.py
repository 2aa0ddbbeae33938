"""Print a markdown table of every registered query's physical plan shape.

    python tests/plan_cards.py [sf_dir] > PLANS.md

Built from ``explain("simple")`` of the plan each key returns (for sink and
job keys: the read-back of what they wrote). The spread exchange of the
fixture's one-row-group input is listed apart: it exists only while the
input has fewer splits than task slots.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def card(plan: str) -> dict:
    exchanges = re.findall(r"Exchange (\w+)(?:\(([^)]*)\))?", plan)
    spread = [e for e in exchanges if e[0] == "hashpartitioning" and e[1].startswith("o_orderkey")]
    shuffles = []
    for kind, arg in exchanges:
        if (kind, arg) in spread:
            continue
        if kind == "hashpartitioning":
            keys = ", ".join(re.sub(r"#\d+L?", "", k) for k in arg.split(", ")[:-1])
            shuffles.append(f"hash({keys})")
        elif kind == "rangepartitioning":
            shuffles.append("range (sort)")
        else:
            shuffles.append(kind)
    partial = "partial_" in plan
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    cols = sorted({c.split(":")[0] for s in scans for c in s.split(",") if c})
    if not cols and "FileScan parquet" in plan:
        cols = ["written output, all columns"]     # long schemas are cut short in the plan text
    return {
        "shuffles": "; ".join(shuffles) or "none",
        "combine": "yes" if partial else "-",
        "topk": "yes" if "TakeOrderedAndProject" in plan else "-",
        "scan": ", ".join(cols),
        "spread": "yes" if spread else "-",
    }


def main() -> None:
    import __spark_entry__ as E
    from ordwise.session import build_session
    from tests.conftest import plan_text

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("local[8]", shuffle_partitions=8)
    print("# PLANS\n")
    print("Physical plan shape of every registered key, from `explain(\"simple\")` at")
    print(f"`{sf}` (regenerate with `python tests/plan_cards.py`). *Shuffles* lists")
    print("the exchanges that exist at any scale and what they partition on;")
    print("*combine*: grouped rows are pre-aggregated in each task before a shuffle;")
    print("*top-k*: `TakeOrderedAndProject` (each task keeps k rows); *scan*: columns")
    print("read from the driver's table (or from the written output, for sinks and")
    print("jobs); *spread*: the local-only hash exchange that deals a one-row-group")
    print("file over the task slots (absent once splits cover the slots).\n")
    print("| Key | Shuffles | Combine | Top-k | Scan | Spread |")
    print("| --- | --- | --- | --- | --- | --- |")
    for k, f in E.QUERIES.items():
        c = card(plan_text(f(spark, sf), "simple"))
        print(f"| `{k}` | {c['shuffles']} | {c['combine']} | {c['topk']} | {c['scan']} | {c['spread']} |")

    from ordwise.functions.derive import transform_df
    from ordwise.operators import quality
    from ordwise.sources import parquet
    from ordwise.sources.fixture import load_orders
    derived = transform_df(load_orders(spark, sf))
    steps = {
        "extract gate (one aggregate)": quality.qc_report(derived),
        "extract write, placement rebalance": parquet._place(derived, "order_status", "rebalance"),
        "extract write, placement local": parquet._place(derived, "order_status", "local"),
        "extract write, placement 4": parquet._place(derived, "order_status", 4),
    }
    print("\nInside the extract job (the registered keys above show what it wrote):\n")
    print("| Step | Shuffles | Combine | Top-k | Scan | Spread |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name, df in steps.items():
        plan = plan_text(df, "simple")
        c = card(plan)
        if "RebalancePartitions" in plan or "REBALANCE_PARTITIONS" in plan:
            c["shuffles"] = c["shuffles"].replace("hash(order_status)", "rebalance(order_status)")
        print(f"| {name} | {c['shuffles']} | {c['combine']} | {c['topk']} | {c['scan']} | {c['spread']} |")
    spark.stop()


if __name__ == "__main__":
    main()
