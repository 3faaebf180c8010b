import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from salesloom.operators import history

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
LAYOUT = "id string, stage string, value int, title string"
CHECKED = ["stage", "value"]


def day(n):
    return START + timedelta(days=n)


def frame(spark, rows):
    return spark.createDataFrame(rows, LAYOUT)


def content(df):
    columns = ["id", "stage", "value", "title", "valid_from", "valid_to"]
    return sorted(map(str, map(tuple, df.select(columns).collect())))


def test_versions(spark):
    first = history.scd2_init(
        frame(spark, [("a", "x", 1, "t"), ("b", None, 2, "t"), ("c", "x", 3, "t")]), "id", day(0)
    )
    later = frame(spark, [("a", "x", 1, "other"), ("b", "x", 2, "t"), ("d", "y", 4, "t")])
    merged = history.scd2_merge(first, later, "id", CHECKED, day(1))
    assert content(merged) == sorted(
        str((*row, a.replace(tzinfo=None), b and b.replace(tzinfo=None)))
        for *row, a, b in [
            ("a", "x", 1, "t", day(0), None),  # a change in an unchecked column is no version
            ("b", None, 2, "t", day(0), day(1)),  # NULL to a value is
            ("b", "x", 2, "t", day(1), None),
            ("c", "x", 3, "t", day(0), None),  # missing from the source stays open
            ("d", "y", 4, "t", day(1), None),
        ]
    )
    assert merged.columns == first.columns
    ids = [r.scd_id for r in merged.collect()]
    assert len(set(ids)) == len(ids)

    again = history.scd2_merge(merged, later, "id", CHECKED, day(2))
    assert content(again) == content(merged)
    assert history.scd2_current(merged).count() == 4
    at = {r.id: r.stage for r in history.scd2_as_of(merged, day(0.5)).collect()}
    assert at == {"a": "x", "b": None, "c": "x"}
    assert history.scd2_as_of(merged, day(1)).where("id = 'b'").first().stage == "x"
    assert history.scd2_as_of(merged, day(-1)).count() == 0


def test_repeated_keys_are_refused_and_keyless_rows_open_each_time(spark):
    first = history.scd2_init(frame(spark, [("a", "x", 1, "t"), (None, "x", 0, "t")]), "id", day(0))
    with pytest.raises(ValueError, match="'a'"):
        twice = frame(spark, [("a", "x", 1, "t"), ("a", "y", 1, "t")])
        history.scd2_merge(first, twice, "id", CHECKED, day(1))
    hot = frame(spark, [("a", "x", 1, "t")] + [(None, "x", i, "t") for i in range(50)])
    merged = history.scd2_merge(first, hot, "id", CHECKED, day(1))
    assert merged.where("id is null").count() == 51
    assert merged.where("id = 'a'").count() == 1


def test_new_source_columns_join_the_history(spark):
    first = history.scd2_init(frame(spark, [("a", "x", 1, "t")]), "id", day(0))
    wider = frame(spark, [("a", "y", 1, "t")]).withColumn("owner", F.lit(5)).drop("title")
    merged = history.scd2_merge(first, wider, "id", CHECKED, day(1))
    rows = {(r.stage, r.title, r.owner) for r in merged.collect()}
    assert rows == {("x", "t", None), ("y", None, 5)}


def model(runs):
    """The same history by plain dictionaries."""
    closed, opened = [], {}
    for n, rows in enumerate(runs):
        for row in rows:
            old = opened.get(row[0])
            if old is not None and old[0][1:3] != row[1:3]:
                closed.append((*old[0], old[1], day(n)))
                old = None
            if old is None:
                opened[row[0]] = (row, day(n))
    versions = closed + [(*row, since, None) for row, since in opened.values()]
    return sorted(
        str((*row, a.replace(tzinfo=None), b and b.replace(tzinfo=None)))
        for *row, a, b in versions
    )


def test_many_runs_in_memory_and_stored_equal_the_model(spark, folder):
    rng = random.Random(11)
    runs = [
        [
            (f"k{i}", rng.choice(["x", "y", None]), rng.randrange(2), f"run {n}")
            for i in rng.sample(range(60), 45)
        ]
        for n in range(4)
    ]
    path = f"{folder}/history"
    merged = None
    for n, rows in enumerate(runs):
        source = frame(spark, rows)
        if n == 0:
            merged = history.scd2_init(source, "id", day(0))
        else:
            merged = history.scd2_merge(merged, source, "id", CHECKED, day(n))
        history.update_history(spark, path, source, "id", CHECKED, day(n), first=n == 0)
    expected = model(runs)
    assert content(merged) == expected
    assert content(history.read_history(spark, path)) == expected
    # The same run again finds nothing to do.
    history.update_history(spark, path, frame(spark, runs[-1]), "id", CHECKED, day(9), first=False)
    assert content(history.read_history(spark, path)) == expected


def test_stored_runs_read_open_versions_only(spark, folder):
    path = f"{folder}/history"
    for n, stage in enumerate("xyz"):
        source = frame(spark, [("a", stage, 1, "t"), ("b", "x", 1, "t")])
        history.update_history(spark, path, source, "id", CHECKED, day(n), first=n == 0)
    assert history.read_history(spark, path).count() == 4
    opened = history.read_open(spark, path)
    assert opened.count() == 2 and all("/closed" not in file for file in opened.inputFiles())


def test_a_column_gained_over_four_runs_keeps_its_values(spark, folder):
    path = f"{folder}/history"
    for n in range(4):
        rows = [("a", "x", n, "t"), ("b", "x", 1, "t"), ("c", "x", min(n, 2), "t")]
        source = frame(spark, rows)
        if n >= 2:
            source = source.withColumn("owner", F.concat(F.lit("o"), F.lit(n)))
        history.update_history(spark, path, source, "id", CHECKED, day(n), first=n == 0)
    got = {(r.id, r.value): r.owner for r in history.read_history(spark, path).collect()}
    assert got == {
        ("a", 0): None, ("a", 1): None, ("a", 2): "o2", ("a", 3): "o3",
        ("b", 1): None, ("c", 0): None, ("c", 1): None, ("c", 2): "o2",
    }


@pytest.mark.parametrize("step", ["first write", "second write", "commit"])
def test_a_run_that_stops_changes_nothing_and_can_run_again(spark, folder, monkeypatch, step):
    path = f"{folder}/history"
    runs = [
        [("a", "x", 0, "t"), ("b", "x", 0, "t")],
        [("a", "y", 0, "t"), ("b", "x", 0, "t")],
        [("a", "y", 1, "t"), ("c", "x", 0, "t")],
    ]
    for n, rows in enumerate(runs[:2]):
        history.update_history(spark, path, frame(spark, rows), "id", CHECKED, day(n), first=n == 0)
    before = content(history.read_history(spark, path))
    with monkeypatch.context() as broken:

        def stop(*args, **more):
            raise RuntimeError("stopped")

        broken.setattr(history, {"first write": "_write_open", "second write": "_write_run", "commit": "_commit"}[step], stop)
        with pytest.raises(RuntimeError, match="stopped"):
            history.update_history(spark, path, frame(spark, runs[2]), "id", CHECKED, day(2), first=False)
    assert content(history.read_history(spark, path)) == before
    for _ in range(2):  # the second time it is committed already
        history.update_history(spark, path, frame(spark, runs[2]), "id", CHECKED, day(2), first=False)
        assert content(history.read_history(spark, path)) == model(runs)
    with pytest.raises(ValueError, match="earlier"):
        history.update_history(spark, path, frame(spark, runs[2]), "id", CHECKED, day(1), first=False)
    with pytest.raises(ValueError, match="a history"):
        history.update_history(spark, path, frame(spark, runs[2]), "id", CHECKED, day(5), first=True)


def data_files(spark, path):
    return {file: os.path.getmtime(file.removeprefix("file://").removeprefix("file:")) for file in path.inputFiles()}


def test_buckets_in_which_no_key_moved_keep_their_files(spark, folder):
    path = f"{folder}/history"
    runs = [[(f"k{i}", "x", 0, "t") for i in range(2000)]]
    bucket = spark.range(2000).select("id", F.pmod(F.hash(F.concat(F.lit("k"), "id")), F.lit(64)).alias("b"))
    few = {r["id"] for r in bucket.where("b in (3, 40)").limit(20).collect()}
    runs.append([(f"k{i}", "y" if i in few else "x", 0, "t") for i in range(2000)])
    runs.append(runs[-1])  # nothing moves
    runs.append([(f"k{i}", "y" if i in few else "x", int(i == 7), "t") for i in range(2100)])
    times = []
    for n, rows in enumerate(runs):
        history.update_history(spark, path, frame(spark, rows), "id", CHECKED, day(n), first=n == 0, buckets=64)
        times.append(data_files(spark, history.read_open(spark, path).where("id is not null")))
    kept = {f: t for f, t in times[0].items() if f in times[1]}
    assert len(times[0]) == 64 and len(kept) == 62 and all(times[1][f] == t for f, t in kept.items())
    assert times[2] == times[1]
    assert content(history.read_history(spark, path)) == model(runs)
    assert history.read_open(spark, path).count() == 2100


def test_the_history_is_compared_without_a_shuffle(spark, folder):
    path = f"{folder}/history"
    rows = [(f"k{i}", "x", 0, "t") for i in range(500)]
    history.update_history(spark, path, frame(spark, rows), "id", CHECKED, day(0), first=True)
    opened = history._open_table(spark, path, history._last_commit(spark, path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keyed = frame(spark, rows).repartition(history.MIN_BUCKETS, "id")
        plan = history._moved_keys(opened, keyed, "id", CHECKED)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert plan.count("Exchange") == 1  # the source's


def test_versions_without_a_key_are_only_added(spark, folder):
    path = f"{folder}/history"
    runs = [[("a", "x", 0, "t")] + [(None, "x", i, "t") for i in range(30)], [("a", "x", 0, "t"), (None, "y", 1, "t")]]
    for n, rows in enumerate(runs):
        history.update_history(spark, path, frame(spark, rows), "id", CHECKED, day(n), first=n == 0)
    assert history.read_open(spark, path).count() == history.read_history(spark, path).count() == 32


def test_what_a_run_left_without_a_commit_is_never_read(spark, folder, monkeypatch):
    """Also when a later run is committed and the stopped one is not run again."""
    path = f"{folder}/history"
    runs = [[("a", "x", 0, "t")], [("a", "y", 0, "t")], [("a", "z", 0, "t")]]
    history.update_history(spark, path, frame(spark, runs[0]), "id", CHECKED, day(0), first=True)
    with monkeypatch.context() as broken:
        broken.setattr(history, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            history.update_history(spark, path, frame(spark, runs[1]), "id", CHECKED, day(1), first=False)
    history.update_history(spark, path, frame(spark, runs[2]), "id", CHECKED, day(2), first=False)
    assert sorted((r.stage, r.valid_to is None) for r in history.read_history(spark, path).collect()) == [("x", False), ("z", True)]


def test_folders_go_when_two_commits_do_without_them(spark, folder):
    path = f"{folder}/history"
    for n in range(5):
        history.update_history(spark, path, frame(spark, [("a", "x", n, "t")]), "id", CHECKED, day(n), first=n == 0, buckets=1)
    assert len(os.listdir(f"{path}/{history.OPEN}/{history.BUCKET}=0")) == 2
    assert history.read_history(spark, path).count() == 5
