"""The batch flow over several landed batches, and stores that follow their input files."""

import json
import os
import shutil

from civicflow.operators.profile import feed_schema, null_ranking
from civicflow.plans.batch import Outputs, clean_batch
from civicflow.plans.tables import clean_store
from civicflow.session import scratch_path
from civicflow.sources.jsonl import read_jsonl, read_lines
from civicflow.sources.sinks import read_clean, read_quarantine

GOOD = dict(agency="AG", complaint_type="T", channel_type="WEB", borough="north", created_date="2025-01-02T03:04:05")


def _feed(spark, root, name, *records):
    path = f"{root}/{name}"
    spark.createDataFrame([(json.dumps(r),) for r in records], "value string").coalesce(1).write.mode("overwrite").text(path)
    return read_jsonl(spark, path)


def test_second_batch_keeps_first_winners_and_counts_rejects_once(spark):
    root = scratch_path(spark, "t-two")
    out = Outputs(f"{root}/out")
    first = _feed(spark, root, "z", {**GOOD, "unique_key": "k", "status": "one"}, {"unique_key": "bad0"})
    second = _feed(spark, root, "a", {**GOOD, "unique_key": "k", "status": "two"}, {"unique_key": "bad1"})
    clean_batch(spark, first, out, 0)
    for _ in range(2):  # the second batch once more: nothing changes
        clean_batch(spark, second, out, 1)
        assert [r.status for r in read_clean(spark, out.clean).collect()] == ["one"]
        rejected = read_quarantine(spark, out.quarantine).collect()
        assert sorted((r.batch_id, r.record_id) for r in rejected) == [(0, "bad0"), (1, "bad1")]
    # the first batch lands again, mended: its reject goes, and its row still wins
    clean_batch(spark, _feed(spark, root, "z2", {**GOOD, "unique_key": "k", "status": "mended"}), out, 0)
    assert [r.status for r in read_clean(spark, out.clean).collect()] == ["mended"]
    assert [r.record_id for r in read_quarantine(spark, out.quarantine).collect()] == ["bad1"]


def test_a_replaced_file_gives_new_answers(spark, sf001, tmp_path):
    """A file of the same number of rows and an older time is another file."""
    events = spark.read.parquet(f"{sf001}/events.parquet")
    target = tmp_path / "in" / "events.parquet"
    for part, condition in enumerate(("event_id < 400", "event_id >= 400 and event_id < 800")):
        events.where(condition).coalesce(1).write.parquet(str(tmp_path / f"v{part}"))
    (file,) = [f for f in os.listdir(tmp_path / "v0") if f.endswith(".parquet")]
    os.makedirs(target)
    shutil.copy(tmp_path / "v0" / file, target / "part.parquet")
    before = {r.unique_key for r in clean_store(spark, str(tmp_path / "in")).collect()}
    (file,) = [f for f in os.listdir(tmp_path / "v1") if f.endswith(".parquet")]
    shutil.copy(tmp_path / "v1" / file, target / "part.parquet")
    os.utime(target / "part.parquet", (1, 1))
    after = {r.unique_key for r in clean_store(spark, str(tmp_path / "in")).collect()}
    assert before and after and not before & after


def test_schema_of_a_feed(spark):
    lines = ['{"a": 1, "b": {"x": [1]}}', '{"a": 2.5, "b": {"y": "t"}}', '{"a": null, "c": true}', "not json", "[1]", '{"c": "t"}']
    path = scratch_path(spark, "t-schema")
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    got = {r.column_name: tuple(r)[1:] for r in feed_schema(read_lines(spark, path)).collect()}
    assert got["a"][0] == "null,number" and got["a"][2:] == (2, 1, 3)
    assert got["b"] == ("object", "OBJECT<x: ARRAY<BIGINT>, y: STRING>", 2, 0, 4)
    assert got["c"] == ("boolean,string", "VARIANT", 2, 0, 4) and set(got) == {"a", "b", "c"}


def test_many_undeclared_keys_are_ranked_without_one_task(spark):
    path = scratch_path(spark, "t-keys")
    lines = [json.dumps({f"k{i:03d}": 1, "all": 2, **({"most": 3} if i else {})}) for i in range(200)]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    ranking = null_ranking(read_jsonl(spark, path), top=216)
    rows = {r.column_name: (r.ordinal, r.nulls, r.rows) for r in ranking.collect()}
    declared = len([k for k in rows if not k.startswith("k0") and not k.startswith("k1") and k not in ("all", "most")])
    assert rows["all"] == (declared, 0, 200) and rows["k000"] == (declared + 1, 199, 200) and rows["most"] == (declared + 201, 1, 200)
    assert "Window" not in ranking._jdf.queryExecution().executedPlan().toString()
