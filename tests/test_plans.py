"""Physical plans have the shape the design relies on at scale."""

from pyspark.sql import functions as F

from civicflow.fixtures import raw_requests
from civicflow.operators import aggregate as agg
from civicflow.operators.dedup import drop_existing
from civicflow.operators.profile import health_check
from civicflow.operators.summary import summary_answers
from civicflow.plans.clean import clean_rows, parse_requests
from civicflow.plans.tables import clean_store
from civicflow.queries import QUERIES
from civicflow.session import scratch_path


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_before_the_shuffle(spark, sf01):
    p = plan(clean_rows(parse_requests(raw_requests(spark, sf01))))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_counts_combine_map_side(spark, sf01):
    clean = clean_store(spark, sf01)
    p = plan(agg.region_volume(clean))
    assert p.count("HashAggregate") >= 2  # partial + final
    assert "TakeOrderedAndProject" in plan(agg.top_types(clean))


def test_summary_ranks_no_list_of_all_types(spark, sf01):
    p = plan(summary_answers(clean_store(spark, sf01)))
    assert "Expand" in p and "TakeOrderedAndProject" in p and p.count("FileScan") == 2
    assert "complaint_type" not in p[p.index("Expand") : p.index("Expand") + 300]


def test_projection_and_filters_reach_the_scan(spark, sf01):
    p = plan(agg.slice_count(clean_store(spark, sf01), "BROOKLYN", "click-1"))
    assert "PushedFilters: [IsNotNull(borough), IsNotNull(complaint_type), EqualTo(borough,BROOKLYN)" in p
    assert "ReadSchema: struct<complaint_type:string,borough:string>" in p


def test_profile_is_one_aggregate(spark, sf01):
    p = plan(health_check(clean_store(spark, sf01)))
    assert p.count("FileScan") == 1


def test_cross_batch_check_does_not_shuffle_the_store(spark, sf01):
    clean = clean_store(spark, sf01)
    new = drop_existing(clean.where(F.col("seq") < 100).limit(100), clean, "unique_key")
    new.collect()
    assert new.count() == 0 and "LeftAnti" in plan(new) and "LeftSemi" in plan(new)


def test_column_keys_read_and_parse_their_own_columns(spark, sf01):
    p = plan(QUERIES["clean_alias"](spark, sf01))
    assert "regexp" not in p and "RLIKE" not in p and "transform(" not in p
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in p


def test_clean_and_quarantine_parse_once(spark, sf001, monkeypatch):
    from civicflow.plans import tables

    seen = []
    monkeypatch.setattr(tables, "clean_rows", lambda df, f=tables.clean_rows: seen.append(plan(df)) or f(df))
    monkeypatch.setattr(tables, "quarantine_rows", lambda df, *a, f=tables.quarantine_rows: seen.append(plan(df)) or f(df, *a))
    tables.run_clean_job(raw_requests(spark, sf001), scratch_path(spark, "t-once"))
    assert len(seen) == 2 and all("regexp" not in p and "event_id" not in p for p in seen)


def test_no_query_uses_a_cartesian_product(spark, sf01):
    cheap = ["q1_region_volume", "q4_channel_share", "summary_publish", "profile_clean", "slice_count",
             "pick_slice", "layout_equivalence", "quarantine_by_type", "union_frames", "region_distinct"]
    for key in cheap:
        p = plan(QUERIES[key](spark, sf01))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, key


def test_validity_filters_never_copy_the_parse(spark, sf01):
    from civicflow.plans.clean import quarantine_rows

    parsed = parse_requests(raw_requests(spark, sf01))
    for df in (clean_rows(parsed), quarantine_rows(parsed)):
        stack, conditions = [df._jdf.queryExecution().optimizedPlan()], []
        while stack:
            node = stack.pop()
            if node.nodeName() == "Filter":
                conditions.append(node.condition().toString())
            kids = node.children()
            stack.extend(kids.apply(i) for i in range(kids.size()))
        assert conditions, "expected validity filters"
        assert not any(w in c for c in conditions for w in ("regexp", "rlike", "RLIKE", "transform")), conditions
