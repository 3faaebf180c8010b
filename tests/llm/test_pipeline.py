"""The pipeline's stages, each against a plain version of what it must keep."""

import brute
import oracle
from pyspark.sql import functions as F

import corpus_pipeline
from salesloom.llm import mixing, near_dedup, packing
from salesloom.operators.staging import _staged, stage

SF = f"{oracle.TESTDATA}/sf0.01"


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, function in corpus_pipeline.STAGES:
        before, docs = docs, stage(function(spark, docs, SF), f"test_{name}")
        kept[name] = (before, docs)
        if name != "pack":
            assert docs.columns == columns
            assert [f.dataType for f in docs.schema] == [f.dataType for f in before.schema]

    before, after = kept["toxicity"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    gone = before.join(after, "doc_id", "left_anti").join(labels, "doc_id")
    assert gone.where("toxic = 1").count() >= 5 * gone.where("toxic = 0").count()
    assert after.count() >= 0.85 * before.count()

    before, after = kept["line_dedup"]
    assert before.count() == after.count()
    lines = after.select(F.explode(F.split("text", "\n")).alias("line"), "source").where("size(split(line, ' ')) > 3")
    spread = lines.groupBy(F.trim("line").alias("line")).agg(F.countDistinct("source").alias("n"))
    assert spread.where("n >= 3").count() == 0

    before, after = kept["near_dedup"]
    groups = brute.near_components([(r["doc_id"], r["text"]) for r in before.select("doc_id", "text").collect()], 80)
    assert {r["doc_id"] for r in after.select("doc_id").collect()} == {root for _, root in groups.values()}

    before, after = kept["mix_sources"]
    assert after.join(before.select("doc_id"), "doc_id", "left_anti").count() == 0
    assert after.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3

    before, after = kept["pack"]
    assert after.columns == [f.split()[0] for f in packing.PIECES.split(", ")]
    sizes = after.groupBy("sequence_id").agg(F.sum(F.expr("octet_length(ids) div 4")).alias("n"))
    assert sizes.where("n > 4096").count() == 0
    assert sizes.agg(F.sum("n")).first()[0] == after.select("doc_id", "doc_tokens").distinct().join(
        before.groupBy("doc_id").count(), "doc_id").agg(F.sum(F.col("doc_tokens") * F.col("count"))).first()[0]


def test_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, copies string, kept string"
    rows = [(1, None, None, None, None, "x", "y"), (2, "", "en", "a", 0, "x", "y"), (None, "some words here", "en", "b", 15, "x", "y")]
    rows += [(3, "some more words", "en", "b", 15, "x", "y")] * 2
    docs = spark.createDataFrame(rows, schema)
    for some in (docs, docs.where("false")):
        now = some
        for name, function in corpus_pipeline.STAGES:
            now = stage(function(spark, now, SF), f"odd_{name}")
            if name != "pack":
                assert now.columns == docs.columns
        assert (now.count() > 0) == (some is docs)


def test_run(spark):
    assert corpus_pipeline.run(spark, f"{oracle.TESTDATA}/sf0.001").count() > 0
    assert near_dedup.PERCENT == 80 and len(corpus_pipeline.STAGES) == 5


def staged_names(spark):
    folder = spark._jvm.org.apache.hadoop.fs.Path(_staged(spark))
    listed = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return {str(s.getPath().getName()) for s in listed}


def test_run_keeps_the_results_of_its_stages_only(spark):
    spark.range(1).transform(lambda df: stage(df, "first"))
    before = staged_names(spark)
    corpus_pipeline.run(spark, f"{oracle.TESTDATA}/sf0.001").count()
    left = {name.rsplit("-", 1)[0] for name in staged_names(spark) - before}
    assert left == {f"{name}_result" for name, _ in corpus_pipeline.STAGES[:-1]}


def test_near_copies_at_eighty_percent(spark):
    """Pairs from 0.78 to 0.86, against brute force over sf0.01 and made ones."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    made = []
    for k in range(120):
        words = [f"p{k}w{i}" for i in range(200)]
        edited = [w if i % 50 or i // 50 >= k % 5 else "x" for i, w in enumerate(words)]
        made += [(10**6 + 2 * k, " ".join(words)), (10**6 + 2 * k + 1, " ".join(edited))]
    both = docs.unionAll(spark.createDataFrame(made, "doc_id long, text string"))
    rows = [(r["doc_id"], r["text"]) for r in both.collect()]
    for percent in (80, 85):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.dedup(both, percent=percent).collect()}
        assert got == brute.near_components(rows, percent)


ODD = "doc_id long, text string, lang string, source string, n_chars long, row string"


def test_one_row_of_each_group_stays(spark):
    """Repeated rows, rows that share an id but not a text, and null ids among near copies."""
    text = lambda k: " ".join(f"w{k}n{i}" for i in range(60))
    rows = [(1, text(1)), (1, text(1)), (1, text(1) + " end"), (2, text(1)), (2, text(2)), (3, text(2) + " end")]
    rows += [(None, text(1)), (None, text(3)), (None, text(3) + " end"), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "a", 1, "x") for i, t in rows], ODD)
    got = corpus_pipeline.keep_one_of_each_group(spark, docs, SF)
    assert got.columns == docs.columns
    kept = [(r["doc_id"], (r["text"] or "").split("n")[0]) for r in got.collect()]
    assert sorted(kept, key=str) == sorted([(1, "w1"), (2, "w2"), (None, "w3"), (None, ""), (None, "")], key=str)


def test_each_row_is_mixed_by_its_own_number(spark):
    """Rows without an id or with one id; a source of a few long texts beside one of short ones."""
    rows = [(None if i % 2 else 7, f"w{i} " * (3000 if i % 40 == 3 else 5), "en", "abc"[i % 3], 1, "x") for i in range(400)]
    docs = spark.createDataFrame(rows + [(1, "z " * 4000, "en", "d", 1, "x")], ODD)
    got = corpus_pipeline.mix_sources(spark, docs, SF)
    assert got.columns == docs.columns
    size = F.size(F.split(F.trim("text"), " "))
    words = {r["source"]: (r["n"], r["most"]) for r in got.groupBy("source").agg(F.sum(size).alias("n"), F.max(size).alias("most")).collect()}
    for r in mixing.mix(docs).select("source", "target").distinct().collect():
        assert abs(words[r["source"]][0] - r["target"]) <= words[r["source"]][1]
    assert got.groupBy("text").count().agg(F.max("count")).first()[0] <= mixing.REPEATS


def test_short_boilerplate_goes(spark):
    rows = [(i, f"own line {i}\nMenu\nLog in", "en", f"s{i}", 1, "x") for i in range(4)]
    got = corpus_pipeline.drop_boilerplate(spark, spark.createDataFrame(rows, ODD), SF)
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {0: rows[0][1]} | {i: f"own line {i}" for i in (1, 2, 3)}
