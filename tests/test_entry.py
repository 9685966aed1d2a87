from irspark.operators.ranking import global_rank


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["query_id", "doc_id", "score"]
    assert df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 90


def test_global_rank_matches_row_number(spark):
    df = spark.range(0, 5000).selectExpr("id % 3 AS g", "cast(id * 7919 % 5003 AS bigint) AS k")
    r = global_rank(df, ["g"], ["k"], "r", num_partitions=7).collect()
    by = {}
    for row in r:
        by.setdefault(row["g"], []).append((row["k"], row["r"]))
    for g, items in by.items():
        items.sort()
        assert [x[1] for x in items] == list(range(1, len(items) + 1))


def test_global_rank_with_payload_and_more_rows_than_the_range_sample(spark):
    df = spark.range(0, 200_000, 1, 16).selectExpr(
        "nullif(id % 3, 2) AS g", "cast(id * 7919 % 200003 AS bigint) AS k", "concat('payload ', id) AS p")
    r = global_rank(df, ["g"], ["k"], "r", num_partitions=16)
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    exact = df.withColumn("e", F.row_number().over(Window.partitionBy("g").orderBy("k")))
    assert r.columns == ["g", "k", "p", "r"]
    assert r.join(exact, ["p"]).filter("r = e").count() == 200_000


def test_query_difficulty_bands_equal_ntile(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from irspark.operators.query_analytics import query_difficulty

    for n in (1, 3, 4, 5, 9, 13):
        df = spark.createDataFrame([(f"q{i:02d}", float(i % 4)) for i in range(n)], "query_id string, m double")
        got = {r["query_id"]: (r["band"], r["hard_rank"]) for r in query_difficulty(df, "m", 4).collect()}
        w = Window.orderBy(F.col("m"), F.col("query_id"))
        exp = {r["query_id"]: (r["b"], r["r"]) for r in
               df.select("query_id", F.ntile(4).over(w).alias("b"), F.row_number().over(w).alias("r")).collect()}
        assert got == exp
