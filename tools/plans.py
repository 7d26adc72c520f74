"""Write PLANS.md: the final (post-AQE) physical operators behind the plan claims of the README.

Usage: python tools/plans.py [sf_dir]

Each query's own physical plan is executed once (rows counted on the
executors, nothing collected); the adaptive plan is then final, so the listing shows the strategies Spark actually used
(broadcast vs. shuffle joins, partial/final WindowGroupLimit, reused stages).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEADLINE = {
    "foundation_purchase_order": "top-1 per key is `WindowGroupLimit` before and after one exchange on the business key",
    "trusted_shipment": "master checks are semi joins whose strategy AQE picks from measured sizes (no hints); the optional "
                        "purchase-order check is one left join on a salted key, so Foundation shipments are scanned once",
    "upsert_two_batches": "the merge's full outer join uses the partitioning of the windows below it; neither side is exchanged again",
}
KEEP = re.compile(r"(Exchange|Join|WindowGroupLimit|HashAggregate|Union|FileScan)")


def outline(df) -> list[str]:
    """The operators of the plan that ran which read, move or combine data; runs it without collecting."""
    qe = df._jdf.queryExecution()
    qe.executedPlan().execute().count()  # this plan itself, so that AQE finalises it
    out, initial = [], None
    for line in qe.executedPlan().toString().splitlines():
        line = re.sub(r"#\d+L?|\[plan_id=\d+\]", "", line)
        depth = len(line) - len(line.lstrip(" :+-"))
        if initial is not None and depth >= initial:
            continue  # below the plan as it was before AQE
        initial = depth if "== Initial Plan ==" in line else None
        if KEEP.search(line):
            filters = re.search(r"PartitionFilters: \[[^\]].*?(?=, PushedFilters)", line)
            out.append(line[:140].rstrip() + (f" ... {filters[0]}" if filters else ""))
    return out


def publishing(spark, sf_dir: str) -> dict[str, tuple[str, object]]:
    """Plans over published tables: the incremental Foundation read, the due keys and the source of a Trusted publish."""
    from stratum.operators.watermark import incremental_after
    from stratum.plans import layered
    from stratum.plans.queries import RUN_TS, ts
    from stratum.plans.specs import spec
    from stratum.plans.trusted import trusted
    from stratum.session import scratch_path
    from stratum.sources import fixtures
    from stratum.streaming.ingest import DATE_COLUMN, raw_schema

    from pyspark.sql import functions as F

    root = scratch_path(spark, "plans")
    raw = fixtures.raw_all(spark, sf_dir)
    layered.run_layered(spark, raw, root, ts(RUN_TS))
    po = raw["purchase_order"].withColumn(DATE_COLUMN, F.trunc("ingestion_timestamp", "month"))
    po.repartition(DATE_COLUMN).write.partitionBy(DATE_COLUMN).parquet(f"{root}/raw")
    stored = spark.read.schema(raw_schema(layered.contract("purchase_order", "raw"))).parquet(f"{root}/raw")
    fnd, trs = (layered.read_layer(spark, root, layer) for layer in ("foundation", "trusted"))
    return {
        "incremental read of Raw": ("the folder filter and the time filter are both on the scan",
                                    incremental_after(stored, fnd["purchase_order"], layered.MARK_COLUMN, date_column=DATE_COLUMN)),
        "due rows of Trusted shipment": ("of the published tables only changes are exchanged",
                                         layered.due_rows(spec("shipment"), fnd["shipment"], layered.tables(spark, root, "trusted")["shipment"])),
        "source of a Trusted shipment publish": ("over published tables; Foundation shipments are scanned once",
                                                 trusted(spec("shipment"), fnd["shipment"], trs)),
    }


def main(sf_dir: str) -> None:
    from stratum.plans.queries import QUERIES
    from stratum.session import build_session

    spark = build_session("local[8]", shuffle_partitions=16)
    plans = {name: (claim, QUERIES[name](spark, sf_dir)) for name, claim in HEADLINE.items()} | publishing(spark, sf_dir)
    lines = ["# Final physical plans (after AQE)", "", f"Generated by `tools/plans.py` at `{sf_dir}` on local[8], 16 shuffle partitions. "
             "Only operators that read, move or combine data are listed.", ""]
    for name, (claim, df) in plans.items():
        lines += [f"## {name}", "", f"What it shows: {claim}.", "", "```", *outline(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
