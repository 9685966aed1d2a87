import random

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark, tmp_path):
    import __spark_entry__ as E
    import corpus_pipeline as P

    from irspark.llm.toxicity import toxicity_scores, train_toxicity

    rng = random.Random(2)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    fresh = lambda n: " ".join(f"q{rng.randrange(10**6)}" for _ in range(n))
    clean = fresh(300)
    extra = [(90001, clean), (90002, clean.upper()), (90003, clean + " more"), (90004, fresh(200) + " " + bench[0] + " " + fresh(200)),
             (90005, fresh(100)), (90006, None), (90007, "")]
    docs = docs.unionByName(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in extra], docs.schema)).checkpoint()
    ids = lambda d: {r["doc_id"] for r in d.select("doc_id").collect()}
    stages = dict(P.STAGES)
    kept = stages["toxicity"](spark, docs, SF)
    scores = toxicity_scores(docs, train_toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    assert kept.schema == docs.schema and ids(kept) == ids(scores.where(F.col("score") < 0.5))
    assert {i for i, _ in extra} <= ids(kept)
    kept = stages["exact_dedup"](spark, kept.checkpoint(), SF)
    assert not {90001, 90006} & ids(kept) and {90002, 90007} <= ids(kept)
    kept = stages["simhash"](spark, kept.checkpoint(), SF)
    assert 90002 in ids(kept) and 90003 not in ids(kept)
    kept = stages["decontamination"](spark, kept.checkpoint(), SF)
    assert 90004 not in ids(kept) and 90005 in ids(kept) and kept.columns == docs.columns
    assert ids(stages["pieces"](spark, kept, SF)) == ids(kept)
    assert E.queries()["pipeline"](spark, SF).where("NOT round_trip").count() == 0
