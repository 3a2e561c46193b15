import corpus_pipeline
from civicflow.llm.common import stored

from .cases import PASSAGE, ROWS, documents


def test_stages_keep_columns_and_take_effect(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    columns, before = docs.columns, docs.count()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    bad = {r["doc_id"] for r in spark.read.parquet(f"{sf001}/labels.parquet").where("quality = 0").collect()}
    good = {r["doc_id"] for r in spark.read.parquet(f"{sf001}/labels.parquet").where("quality = 1").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf001), f"t-{name}")
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
        if name == "quality":
            kept = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert all(texts[i] == t for i, t in kept.items())
            assert len(bad & set(kept)) <= 0.1 * len(bad) and len(good - set(kept)) <= 0.05 * len(good)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf001)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}


def test_planted_cases(spark, sf001):
    item = spark.read.parquet(f"{sf001}/benchmark.parquet").first()["text"]
    words = lambda k, n: " ".join(f"own{k}x{j}" for j in range(n))
    near = words(3, 300)
    rows = [
        (1, words(1, 80) + ". " + PASSAGE + " " + words(11, 20) + "."),
        (2, words(2, 80) + ". " + PASSAGE + " " + words(12, 20) + "."),  # a passage of document 1
        (3, near),
        (4, near.replace("own3x100 ", "changed ")),  # a near copy of 3
        (5, words(5, 200) + " " + item + " " + words(6, 200)),  # a benchmark item inside
        (6, words(7, 100)),  # clean
        (7, words(1, 80) + ". " + PASSAGE + " " + words(11, 20) + "."),  # a copy of 1
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[1:4]:
        docs = stored(stage(spark, docs, sf001), f"t-{name}")
    left = {r["doc_id"]: (r["text"], r["n_chars"]) for r in docs.collect()}
    assert set(left) == {1, 2, 3, 6}
    assert left[1][0] == rows[0][1] and left[6][0] == rows[5][1] and left[3][0] == near
    assert PASSAGE not in left[2][0] and left[2][0].startswith("own2x0") and left[2][1] == len(left[2][0])


def test_run_is_the_stages_in_order(spark, sf001):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
    assert corpus_pipeline.run(spark, sf001).count() > 0


def test_edge_cases_and_an_empty_table(spark, sf001):
    """Nulls, long words, ties, repeated rows and clashing columns go through every stage; so does nothing."""
    for rows in (ROWS, []):
        docs = documents(spark, rows)
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = {r["doc_id"] for r in docs.collect()}
            docs = stored(stage(spark, docs, sf001), f"t-edge-{name}")
            assert docs.columns == columns and {r["doc_id"] for r in docs.collect()} <= before
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf001)
        assert sorted(str(r["doc_id"]) for r in packed.where("piece = 0").collect()) == sorted(str(r["doc_id"]) for r in docs.collect())
        assert (docs.count() > 0) == bool(rows)
