import math

import pytest

from irspark.operators.evaluate import evaluate_run


def test_metrics_hand_computed(spark):
    run = spark.createDataFrame(
        [("q1", "a", 3.0), ("q1", "b", 2.0), ("q1", "c", 1.0), ("q2", "x", 1.0)],
        "query_id string, doc_id string, score double")
    qrels = spark.createDataFrame(
        [("q1", "a", 2), ("q1", "c", 1), ("q1", "z", 1), ("q2", "y", 1), ("q3", "w", 1)],
        "query_id string, doc_id string, relevance int")
    agg, pq = evaluate_run(run, qrels, ["P@1", "P@2", "AP@3", "nDCG@3"], per_query=True)
    per = {r["query_id"]: r for r in pq.collect()}
    # q1: ranks a(2) b(0) c(1); 3 relevant in qrels
    assert per["q1"]["P@1"] == 1.0 and per["q1"]["P@2"] == 0.5
    assert per["q1"]["AP@3"] == pytest.approx((1 / 1 + 2 / 3) / 3)
    dcg = 2 / math.log2(2) + 1 / math.log2(4)
    idcg = 2 / math.log2(2) + 1 / math.log2(3) + 1 / math.log2(4)
    assert per["q1"]["nDCG@3"] == pytest.approx(dcg / idcg)
    # q2 retrieved nothing relevant, q3 absent from the run: both score 0 and count in the mean
    assert per["q2"]["P@1"] == 0.0 and per["q3"]["nDCG@3"] == 0.0
    row = agg.first()
    assert row["P@1"] == pytest.approx(1 / 3)
    for m in ("P@1", "P@2", "AP@3", "nDCG@3"):
        assert 0.0 <= row[m] <= 1.0


def test_ties_break_by_doc_id_desc(spark):
    run = spark.createDataFrame([("q", "a", 1.0), ("q", "b", 1.0)], "query_id string, doc_id string, score double")
    qrels = spark.createDataFrame([("q", "a", 1)], "query_id string, doc_id string, relevance int")
    assert evaluate_run(run, qrels, ["P@1"]).first()["P@1"] == 0.0  # 'b' ranks first (trec_eval)
