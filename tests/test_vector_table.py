import os
import uuid

import pytest
from pyspark.sql import functions as F

from irspark.operators.vector import upsert_vectors, vector_retrieve
from irspark.operators.vector_table import VectorTable, open_vectors

SCHEMA = "item_id string, text string, embedding array<double>, label int"


def points(spark, ids, mark, schema=SCHEMA):
    return spark.createDataFrame([(str(i), f"{mark}{i}", [float(i), 1.0 if mark == "a" else -1.0], i % 7) for i in ids], schema)


def found(df):
    return {r["point_id"]: (r["text"], list(r["embedding"]), r["label"]) for r in df.collect()}


def stamps(table):
    return {b: {f: os.stat(os.path.join(d, f)).st_mtime_ns for f in os.listdir(d)} for b, d in
            ((b, d.removeprefix("file:")) for b, d in table.files().items())}


def test_upsert_rewrites_only_the_buckets_of_the_batch(spark, tmp_path):
    table = VectorTable(spark, "points", str(tmp_path), buckets=8)
    assert not table.exists()
    with pytest.raises(ValueError, match="does not exist"):
        table.read()
    table.upsert(points(spark, range(100), "a"))
    before, opened = stamps(table), table.read()
    batch = points(spark, [3, 500], "b")
    touched = {r["b"] for r in batch.select(F.pmod(F.xxhash64("item_id"), F.lit(8)).alias("b")).collect()}
    table.upsert(batch)
    after = stamps(table)
    assert len(before) == 8 and {b for b in before if before[b] != after[b]} == touched != set(before)
    want = {str(i): (f"a{i}", [float(i), 1.0], i % 7) for i in range(100)}
    assert found(opened) == want                                       # who has it open keeps what was there
    want.update({str(i): (f"b{i}", [float(i), -1.0], i % 7) for i in (3, 500)})
    assert found(table.read()) == found(VectorTable(spark, "points", str(tmp_path)).read()) == want
    assert table.read().count() == 101


def test_batches_with_repeated_ids_nulls_and_fewer_columns(spark, tmp_path):
    table = VectorTable(spark, "t", str(tmp_path), buckets=3)
    rows = [("1", "old", [1.0], 1.5, 1), ("01", "new", [2.0], float("nan"), 3), ("1", "mid", [3.0], 2.5, 2), (None, None, [4.0], None, 1)]
    table.upsert(spark.createDataFrame(rows, "item_id string, text string, embedding array<double>, x double, n int"), seq_col="n")
    got = {r["point_id"]: r for r in table.read().collect()}
    assert len(got) == 2 and got["1"]["text"] == "new" and got["1"]["x"] is None and got[None]["embedding"] == [4.0]
    table.upsert(spark.createDataFrame([("2", "two", [5.0])], "item_id string, text string, embedding array<double>"))
    assert {r["item_id"]: r["x"] for r in table.read().where("item_id = '2'").collect()} == {"2": None}
    files = table.files()
    table.upsert(spark.createDataFrame([], "item_id string, text string, embedding array<double>"))
    for bad in ([("2", "x", [1.0, 2.0])], [("2", "x", None)]):
        with pytest.raises(ValueError, match="one length, 1"):
            table.upsert(spark.createDataFrame(bad, "item_id string, text string, embedding array<double>"))
    with pytest.raises(ValueError, match="no column other"):
        table.upsert(spark.createDataFrame([("2", "x", [1.0], 1)], "item_id string, text string, embedding array<double>, other int"))
    assert table.files() == files


def test_an_existing_table_is_not_embedded_again(spark):
    docs = spark.createDataFrame([("1", "a b"), ("2", "b c")], "item_id string, text string")
    calls, name = [], f"named-{uuid.uuid4().hex}"

    def embed(df):
        calls.append(1)
        return df.withColumn("embedding", F.array(F.length("text").cast("double"), F.col("item_id").cast("double")))

    first = open_vectors(spark, name, docs, embed)
    again = open_vectors(spark, name, docs, embed)
    assert len(calls) == 1 and found_ids(first) == found_ids(again) == {"1", "2"}
    query = spark.createDataFrame([("q", [3.0, 1.0])], "query_id string, embedding array<double>")
    assert vector_retrieve(query, open_vectors(spark, name).read(), 1).first()["doc_id"] == "1"
    with pytest.raises(ValueError, match="does not exist"):
        open_vectors(spark, name + "-other")
    with pytest.raises(ValueError, match="at least one document"):
        open_vectors(spark, name + "-other", docs.limit(0), embed)


def found_ids(table):
    return {r["item_id"] for r in table.read().collect()}


def test_upsert_of_frames_windows_over_the_batch_only(spark):
    table = upsert_vectors(None, points(spark, range(50), "a")).checkpoint()
    out = upsert_vectors(table, points(spark, [4, 77], "b"))
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()   # the batch is written by then
    got = found(out)
    assert len(got) == 51 and got["4"][0] == "b4" and got["5"][0] == "a5"
