import numpy as np

from civicflow.llm import quality
from civicflow.llm.queries import op6_quality

from .cases import ROWS, documents


def test_held_out_accuracy(spark, sf01):
    labels = spark.read.parquet(f"{sf01}/labels.parquet")
    rows = op6_quality(spark, sf01).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.97
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    assert len(bad) > 10 and np.mean([[g > b for b in bad] for g in good]) >= 0.98
    assert op6_quality(spark, sf01).count() == spark.read.parquet(f"{sf01}/documents.parquet").count()


def test_compiled_rules_equal_the_fitted_ones(spark):
    rng = np.random.default_rng(1)
    x = rng.random((400, len(quality.STATS)))
    y = ((x[:, 3] > 0.6) | (x[:, 6] <= 0.2)).astype(float)
    model = quality.fit_rules(x, y)
    assert 0 < len(model.rules) < 120  # the lasso drops rules
    total = model.bias + sum(w * np.logical_and.reduce([c.holds(x) for c in r]) for r, w in model.rules)
    want = 1 / (1 + np.exp(-total))
    df = spark.createDataFrame([(k, tuple(map(float, row))) for k, row in enumerate(x)], f"k int, s {quality.STATS_TYPE.simpleString()}")
    got = [r["p"] for r in df.select("k", model.score("s").alias("p")).orderBy("k").collect()]
    assert np.allclose(got, want)
    assert np.mean((want >= 0.5) == (y > 0)) > 0.95


def test_stats_of_known_texts():
    import pyarrow as pa

    got = quality.text_stats(pa.array(["AB c!\nAB c!", "", None, "a a a a"], pa.large_string()))
    assert got["upper_share"][0] == 4 / 11 and got["bang_share"][0] == 2 / 11
    assert got["distinct_share"][0] == 0.5 and got["repeated_line_share"][0] == 0.5
    assert all(v[1] == 0 and v[2] == 0 for v in got.values())
    assert got["distinct_share"][3] == 0.25 and np.isclose(got["log_words"][3], np.log1p(4))


def test_edge_cases(spark):
    labels = spark.createDataFrame(
        [(0, 1, "x"), (0, 0, "x"), (5, 1, "x"), (None, 1, "x"), (7, None, "x"), (8, 0, "x")], "doc_id long, quality int, text string"
    )
    rows = quality.quality_scores(documents(spark), labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (2, 3)}) == 1
    none = labels.limit(0)
    assert {r["score"] for r in quality.quality_scores(documents(spark), none).collect()} == {0.5}
    assert quality.quality_scores(documents(spark, []), labels).collect() == []
    kept = quality.keep_quality(documents(spark), none)
    assert kept.columns == documents(spark).columns and kept.count() == len(ROWS)
