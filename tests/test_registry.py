"""Keys that last from build to build."""

import os

from pyspark.sql import functions as F

from salesloom.operators import keys, registry
from salesloom.plans import silver

ROWS = "id long, name string, note string"


def build(spark, path, rows, **options):
    got = registry.lasting_key(spark.createDataFrame(rows, ROWS), path, "id", ["name"], "sk", **options)
    assert got.columns == ["sk", "id", "name", "note"]
    return {(r["id"], r["name"], r["note"]): r["sk"] for r in got.collect()}


def test_a_new_member_leaves_other_keys_alone(spark, folder):
    path = f"{folder}/keys"
    rows = [(None, "bia", "x"), (7, "caio", "x"), (None, "dora", "x"), (None, "dora", "y"), (None, None, "z")]
    first = build(spark, path, rows)
    assert first[(7, "caio", "x")] == 7
    assert first[(None, None, "z")] == 100001 and first[(None, "bia", "x")] == 100002
    assert first[(None, "dora", "x")] == first[(None, "dora", "y")] == 100003
    files = {f: os.path.getmtime(f"{d}/{f}") for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    second = build(spark, path, [*rows, (None, "ana", "new"), (8, "ana", "id")])
    assert {k: v for k, v in second.items() if k in first} == first
    assert second[(None, "ana", "new")] == 100004 and second[(8, "ana", "id")] == 8
    after = {f: os.path.getmtime(f"{d}/{f}") for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    assert files.items() <= after.items()
    assert build(spark, path, rows[:1]) == {(None, "bia", "x"): 100002}
    third = build(spark, path, [(None, "zeca", "")])
    assert third == {(None, "zeca", ""): 100005}


def test_first_build_numbers_like_the_plain_key(spark, folder):
    df = spark.createDataFrame([(None if i % 3 else i, f"n{i * 37 % 101}", "") for i in range(100)], ROWS)
    plain = df.where("id is null")
    want = {r["name"]: r["sk"] for r in keys.surrogate_key(plain, "id", ["name"], "sk").collect()}
    got = registry.lasting_key(df, f"{folder}/keys", "id", ["name"], "sk").where("id is null").collect()
    assert {r["name"]: r["sk"] for r in got} == want


def test_a_build_that_was_not_committed_gives_no_number(spark, folder, monkeypatch):
    path = f"{folder}/keys"
    build(spark, path, [(None, "bia", "")])
    stopped = f"{path}/{registry.NUMBERS}/{registry.BUILD}=stopped"
    spark.createDataFrame([("ana", 2)], "name string, registry_number long").write.parquet(stopped)
    assert build(spark, path, [(None, "caio", ""), (None, "ana", "")]) == {(None, "ana", ""): 100002, (None, "caio", ""): 100003}


def test_empty_tables(spark, folder):
    assert build(spark, f"{folder}/keys", []) == {}
    assert build(spark, f"{folder}/keys", [(3, "a", "")]) == {(3, "a", ""): 3}
    assert build(spark, f"{folder}/keys", [(None, "a", "")]) == {(None, "a", ""): 100001}


def test_sellers_keep_their_keys(spark, folder):
    deals = spark.createDataFrame([("x1", "Bia"), ("x2", "Dora"), ("5", "Caio")], "owner_id string, owner_name string")
    path = f"{folder}/sellers"
    first = {r["nome_vendedor"]: r["sk_vendedor"] for r in silver.seller_dim(deals, key_registry=path).collect()}
    more = deals.unionAll(spark.createDataFrame([("x0", "Ana")], deals.schema))
    second = {r["nome_vendedor"]: r["sk_vendedor"] for r in silver.seller_dim(more, key_registry=path).collect()}
    assert first == {"Bia": 100001, "Dora": 100002, "Caio": 5} and second == {**first, "Ana": 100003}
    plain = silver.seller_dim(more).where(F.col("nome_vendedor") == "Bia").first()["sk_vendedor"]
    assert plain != first["Bia"]
