import numpy as np
from pyspark.sql import functions as F

from flowmart.llm import neighbours
from flowmart.llm.queries import op8_neighbour_votes


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    for value in np.unique(scores):
        ranks[scores == value] = ranks[scores == value].mean()
    good = labels == 1
    n, m = good.sum(), (~good).sum()
    return (ranks[good].sum() - n * (n + 1) / 2) / (n * m)


def test_votes_match_the_plain_form():
    rng = np.random.default_rng(2)
    points, labelled = rng.standard_normal((700, 8)), rng.standard_normal((90, 8))
    points, labelled = neighbours._unit(points), neighbours._unit(labelled)
    points[3] = 0
    labels = (rng.random(90) < 0.6).astype(float)
    got = neighbours.votes(points, labelled, labels, 7)
    for k, point in enumerate(points):
        cosine = labelled @ point
        near = np.argsort(-cosine)[:7]
        weight = np.maximum(cosine[near], 0)
        want = (weight * labels[near]).sum() / weight.sum() if weight.sum() > 1e-9 else labels.mean()
        assert abs(got[k] - want) < 1e-9


def test_held_out_quality(spark):
    found = op8_neighbour_votes(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = found.where("held_out").join(labels, "doc_id").select("score", "quality", "predicted").toPandas()
    assert auc(rows.score.to_numpy(), rows.quality.to_numpy()) > 0.95
    assert (rows.predicted == rows.quality).mean() > 0.93


def test_defined_cases(spark, documents):
    rows = [(k, f"good text number {k} is fine") for k in range(20)] + [(100 + k, f"BUY!!! {k} NOW!!! $$$") for k in range(20)]
    odd = [(200, None), (201, ""), (202, " \n"), (None, "good text"), (203, "z " * 300_000), (5, "good text number 5 is fine")]
    docs = documents(rows + odd)
    labels = spark.createDataFrame(
        [(k, 1) for k in range(20)] + [(100 + k, 0) for k in range(20)] + [(None, 1), (3, None), (3, 1), (999, 0)], "doc_id long, label int"
    )
    model = neighbours.fit(docs, labels)
    assert len(model["labels"]) == 41  # doc 5 is there twice
    scored = docs.select("doc_id", neighbours.score("text", model, spark).alias("s")).collect()
    assert len(scored) == len(rows + odd)
    by_id = {r.doc_id: r.s for r in scored}
    assert by_id[4] > 0.9 and by_id[104] < 0.1
    assert by_id[200] == by_id[201] == by_id[202] == model["labels"].mean()
    assert all(0 <= r.s <= 1 for r in scored)


def test_without_rows_or_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, label int")
    assert neighbours.fit(documents([(1, "a b")]), none) is None
    assert documents([(1, "a b")]).select(neighbours.score("text", None, spark)).first()[0] == 0.5
    assert neighbours.fit(documents([]), none) is None


def test_sample_is_bounded(spark, documents):
    docs = documents([(k, f"text {k}") for k in range(50)])
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("label"))
    assert len(neighbours.fit(docs, labels, sample=10)["labels"]) == 10
