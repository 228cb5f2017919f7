"""Queries over whole tables, on rows beyond the first thousands, against the rows of their SQL."""

import duckdb

import __spark_entry__ as entry


def same_rows(spark, folder, table, frame, name):
    frame.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{table}.parquet")
    df = entry.queries()[name](spark, str(folder))
    duck = duckdb.connect()
    duck.execute(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    want = duck.execute(f"select {', '.join(f'"{c}"' for c in df.columns)} from ({entry.oracle_sql()[name]})").fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return got


def test_stream_cap_over_chunks(spark, tmp_path):
    """Keys of several chunks that arrive last first."""
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "60")
    try:
        events = spark.range(9000).selectExpr("8999 - id as event_id")
        got = same_rows(spark, tmp_path, "events", events, "stream_domain_cap")
    finally:
        spark.conf.set(size, before)
    assert len(got) == 9000 and sum(r[2] == "added" for r in got) == 2300


def test_prepared_queue_of_all_tiers(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"https://h{i}.com/a", b"<p>") for i in (0, 99, 100, 399, 400, 999, 1000, 9999, 10000, 99999, 100000, 250000)], "page_id long, url string, html binary")
    got = same_rows(spark, tmp_path, "pages", pages, "prepared_queue")
    assert {r[4] for r in got} == {"priority_high", "priority_medium", "priority_normal", "priority_low"}


def test_text_functions_of_whole_texts(spark, tmp_path):
    texts = ["é" * 90 + " tail, " + "b " * 60 + ", c, d,e , f, g", "a" * 70 + ",ü\n, x", "", ",,", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: r[1:] for r in same_rows(spark, tmp_path, "documents", docs, "text_functions")}
    assert got[0][1].startswith(" tail, b b") and got[1][:2] == ("a" * 70 + "|ü\n|x", "a" * 70 + ",\n, x")
