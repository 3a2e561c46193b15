"""A key holding a third of all rows: results stay exact and the hot key is not shipped whole."""

from pyspark.sql import functions as F

from civicflow.fixtures import raw_requests
from civicflow.operators import aggregate as agg
from civicflow.plans.clean import clean_rows, parse_requests


def _exchange_records(df) -> list[int]:
    """Run ``df`` (AQE off, so the plan's nodes are the executed ones) and read each exchange's
    shuffled record count."""
    spark = df.sparkSession
    previous = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        planned = df.select("*")
        planned.collect()  # runs this Dataset's own plan, whose metrics are read below
        plan = planned._jdf.queryExecution().executedPlan()
        out = []
        stack = [plan]
        while stack:
            node = stack.pop()
            if node.nodeName().startswith("Exchange"):
                out.append(int(node.metrics().apply("shuffleRecordsWritten").value()))
            children = node.children()
            stack.extend(children.apply(i) for i in range(children.size()))
        return out
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", previous)


def test_hot_key_dedup_is_exact_and_collapses_before_the_shuffle(spark, sf01):
    raw = raw_requests(spark, sf01)
    hot = raw.withColumn(
        "unique_key", F.when(F.col("seq") % 3 == 0, F.lit("HOT")).otherwise(F.col("unique_key"))
    )
    parsed = parse_requests(hot)
    clean = clean_rows(parsed)
    # exact: the hot key keeps its smallest valid seq
    valid_hot = parsed.where((F.col("unique_key") == "HOT") & F.col("agency").isNotNull()
                             & F.col("created_date").isNotNull())
    want = valid_hot.agg(F.min("seq")).first()[0]
    got = clean.where(F.col("unique_key") == "HOT").collect()
    assert len(got) == 1 and got[0].seq == want
    # the exchange on unique_key carries at most one HOT row per map task
    records = _exchange_records(clean)
    hot_rows = valid_hot.count()
    distinct_keys = clean.count()
    dedup_exchange = min(records)  # the other exchange spreads the small input evenly
    assert hot_rows > 3000 and dedup_exchange > 0
    # shipping the hot key whole would add ~3,000 rows; only a few ordinary duplicates
    # and one HOT row per map task cross the exchange
    assert dedup_exchange < distinct_keys + 300


def test_hot_borough_counts_are_exact(spark, sf01):
    raw = raw_requests(spark, sf01).withColumn(
        "borough", F.when(F.col("seq") % 3 == 0, F.lit("MANHATTAN")).otherwise(F.col("borough"))
    )
    clean = clean_rows(parse_requests(raw))
    by = {r.borough: r["count"] for r in agg.region_volume(clean).collect()}
    assert sum(by.values()) == clean.count()
    assert by["MANHATTAN"] > 3000
