"""Write PLANS.md: the executed physical plans of the headline queries (sf0.01).

    python tools/dump_plans.py [sf_dir]

Each query is run once, so the plans shown are AQE's final plans.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NOTES = {
    "dedup_keep_first": "Parse once behind the row barrier (Generate), then one exchange on unique_key; "
    "the partial WindowGroupLimit before it ships at most one row per key per map task (hot keys collapse). "
    "The parse projection below the Generate has no `*`: the lambda that binds the date's regex groups "
    "once is interpreted; canonical ISO texts never reach it.",
    "clean_alias": "A column key: the bare projection reads two columns of the events and parses nothing else.",
    "q1_region_volume": "Partial HashAggregate before the exchange; the sort only sees one row per borough.",
    "q2_top_types": "TakeOrderedAndProject: per-partition top-5, no global sort.",
    "q4_channel_share": "The total is a window over the aggregated rows only; the sort reuses its single partition.",
    "summary_publish": "Boroughs, hours and channels from one scan with GROUPING SETS (Expand, partial aggregation "
    "before the exchange); complaint types by their own counts and an ordered limit (TakeOrderedAndProject).",
    "slice_count": "Both predicates and a two-column ReadSchema reach the Parquet scan.",
    "layout_hive_count": "PartitionFilters: only the borough's directory is listed and read; no data column is read.",
    "layout_equivalence": "Both layouts counted in one job (union + one aggregate), no join.",
    "profile_clean": "One global aggregate: each task emits one partial row, then explode to one row per column.",
    "sample_systematic": "Global rank without a single-task window: checkpointed range partitions, "
    "per-partition counts (tiny) broadcast back as offsets.",
    "dedup_cross_batch": "Second arrival: the store's keys are reduced to the batch's by a semi-join, and the batch is "
    "anti-joined with those; AQE broadcasts the small sides it finds at run time.",
}


def _tree(formatted: str) -> str:
    head = formatted.split("\n\n")[0]
    details = re.findall(r"^(?:PushedFilters|PartitionFilters|ReadSchema|Arguments): .*$", formatted, re.M)
    keep = [d for d in details if not d.startswith("Arguments") or "partitioning" in d or "Partial" in d]
    return head.strip() + ("\n\n" + "\n".join(sorted(set(keep), key=keep.index)) if keep else "")


def main(argv: list[str]) -> None:
    from civicflow.session import local_session
    from civicflow.queries import QUERIES
    from civicflow.operators.dedup import drop_existing
    from civicflow.fixtures import raw_requests
    from civicflow.plans.clean import clean_rows, parse_requests
    from civicflow.sources.sinks import read_clean
    from civicflow.session import scratch_path
    from civicflow.sources.sinks import write_clean
    from pyspark.sql import functions as F

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(8)
    out = [
        "# Physical plans of the headline queries",
        "",
        f"Generated by `tools/dump_plans.py` on `{sf_dir}` (`local[8]`, AQE on, plans after execution).",
        "Trees are Spark's own `explain(\"formatted\")` output; the notes say what to look for.",
        "",
    ]
    for key, note in NOTES.items():
        if key == "summary_publish":
            from civicflow.operators.summary import summary_answers, summary_records
            from civicflow.plans.tables import clean_store

            df = summary_records(summary_answers(clean_store(spark, sf_dir)))
        elif key == "dedup_cross_batch":
            raw = raw_requests(spark, sf_dir)
            path = scratch_path(spark, "plans-cross")
            write_clean(clean_rows(parse_requests(raw.where(F.col("seq") < 5000))), path)
            batch = clean_rows(parse_requests(raw.where(F.col("seq") >= 5000)))
            df = drop_existing(batch, read_clean(spark, path), "unique_key")
        else:
            df = QUERIES[key](spark, sf_dir)
        df.collect()
        formatted = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        out += [f"## `{key}`", "", note, "", "```", _tree(formatted), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
