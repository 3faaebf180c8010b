"""The digest index: verdicts, later batches, and running a batch again."""

from salesloom.llm import exact_dedup

DOCS = "doc_id long, text string, digest string, keep_id int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 0) for i, t in rows], DOCS)


def verdicts(df):
    return {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in df.collect()}


def test_batches(spark):
    path = exact_dedup.new_index_path(spark)
    first = frame(spark, [(5, "a  b"), (3, "a\n\tb"), (7, "a b "), (8, None), (9, "")])
    assert verdicts(exact_dedup.dedup(first, path)) == {
        5: (3, 2, False), 3: (3, 2, True), 7: (7, 1, True), 8: (8, 2, True), 9: (8, 2, False)
    }
    second = frame(spark, [(1, "a b"), (2, "new"), (4, "new")])
    expected = {1: (3, 1, False), 2: (2, 2, True), 4: (2, 2, False)}
    assert verdicts(exact_dedup.dedup(second, path)) == expected
    assert verdicts(exact_dedup.dedup(second, path)) == expected
    index = spark.table(exact_dedup.open_index(spark, path))
    assert index.count() == index.select("digest").distinct().count() == 4


def test_index_is_met_bucket_by_bucket(spark):
    path = exact_dedup.new_index_path(spark)
    docs = frame(spark, [(i, str(i % 40)) for i in range(100)])
    exact_dedup.dedup(docs, path)
    name = exact_dedup.open_index(spark, path)
    known = spark.table(name).select("digest").hint("merge")
    batch = spark.table(name).repartition(64, "digest")
    plan = batch.join(known, "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert sum(1 for p in spark.read.parquet(path).inputFiles() if p) <= 64


def test_nulls_long_texts_and_no_rows(spark):
    long = "word " * 200_000
    df = frame(spark, [(None, "x"), (None, "x"), (1, long), (2, long + "\n"), (None, long), (4, "same"), (4, "same")])
    got = sorted(map(str, exact_dedup.dedup(df, exact_dedup.new_index_path(spark)).drop("text_sha256").collect()))
    assert len(got) == 7
    by = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.dedup(df, exact_dedup.new_index_path(spark)).collect()]
    assert sorted(by, key=str) == sorted(
        [(None, None, 2, True)] * 2 + [(1, 1, 3, True), (2, 1, 3, False), (None, 1, 3, False)] + [(4, 4, 2, True)] * 2, key=str
    )
    empty = exact_dedup.dedup(df.where("false"), exact_dedup.new_index_path(spark))
    assert empty.count() == 0
