"""Type-2 history: one row per version of a record, with the time it was valid."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesloom.operators.keys import assert_unique
from salesloom.operators.staging import stage
from salesloom.sources import files

# Folders of a stored history: open versions by bucket of their key and by what wrote them, open
# versions without a key and closed ones by run, commits.
OPEN, KEYLESS, CLOSED, COMMITS = "open", "keyless", "closed", "commits"
COMMIT = "number bigint, run string, layout string, written array<string>"
BUCKET, WRITTEN, RUN_COLUMN = "history_bucket", "written_by", "run"
# Rows that make a bucket when a history begins, and how many buckets there may be.
ROWS_PER_BUCKET, MIN_BUCKETS, MAX_BUCKETS = 200_000, 16, 16_384
HOUSEKEEPING = ("scd_id", "updated_at", "valid_from", "valid_to")


def _utc(moment: datetime) -> datetime:
    """The same moment with a time zone; one without is taken as UTC."""
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def _timestamp(moment: datetime) -> Column:
    return F.lit(_utc(moment)).cast("timestamp")


def _opened(columns: Sequence[Column], key: Column, run_time: datetime) -> list[Column]:
    """A version that starts at ``run_time``."""
    run_text = _utc(run_time).astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    return [
        *columns,
        F.md5(F.concat_ws("|", key.cast("string"), F.lit(run_text))).alias("scd_id"),
        _timestamp(run_time).alias("updated_at"),
        _timestamp(run_time).alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    ]


def scd2_init(source: DataFrame, key: str, run_time: datetime) -> DataFrame:
    """First load: every source row is an open version."""
    columns = [F.col(c) for c in source.columns]
    return source.select(*_opened(columns, F.col(key), run_time))


def scd2_merge(
    history: DataFrame,
    source: DataFrame,
    key: str,
    checked: Sequence[str],
    run_time: datetime,
) -> DataFrame:
    """History after one more load of the source.

    A record whose checked columns differ (NULL counts as a value) closes its open version and
    opens a new one. Records missing from the source stay open. Changes in other columns alone
    make no version. A source row without a key matches nothing, so it opens a version each
    time. A source in which a key repeats is refused.

    Whole rows are not shuffled to be compared. Keys and checked columns find the keys that
    moved, and those are stored. Most loads move few keys, so joining them to the whole rows of
    both sides is a broadcast by their real size; if many moved, Spark sorts instead.
    """
    is_open = F.col("valid_to").isNull() & F.col(key).isNotNull()
    keyed = source.where(F.col(key).isNotNull())
    moved = _moved(history.where(is_open), keyed, key, checked)
    return _merged(history, source, moved, key, run_time)


def _moved(opened: DataFrame, source: DataFrame, key: str, checked: Sequence[str]) -> DataFrame:
    """The stored keys that need a new version; a key that the source repeats is refused."""
    moved = stage(_moved_keys(opened, source, key, checked), "moved-keys")
    repeated = moved.where("_copies > 1").take(3)
    if repeated:
        raise ValueError(f"repeated {key}: {[row[key] for row in repeated]}")
    return moved


def _merged(
    history: DataFrame, source: DataFrame, moved: DataFrame, key: str, run_time: datetime
) -> DataFrame:
    """``history`` with the open versions of moved keys closed, and the versions that start."""
    is_open = F.col("valid_to").isNull() & F.col(key).isNotNull()
    tracked = [c for c in history.columns if c not in HOUSEKEEPING]
    added = [c for c in source.columns if c not in tracked]
    types = {f.name: f.dataType for f in (*source.schema, *history.schema)}

    def data(df: DataFrame) -> list[Column]:
        return [
            (F.col(c) if c in df.columns else F.lit(None)).cast(types[c]).alias(c)
            for c in (*tracked, *added)
        ]

    # One scan of each side. Rows that are closed or have no key pass through the left joins.
    old = history.select(*data(history), *HOUSEKEEPING)
    closing = moved.where("_known").select(F.col(key).alias("_closing"))
    closes = F.col("_closing").isNotNull()
    kept = old.join(closing, (old[key] == closing["_closing"]) & is_open, "left").select(
        *[c for c in old.columns if c != "valid_to"],
        F.when(closes, _timestamp(run_time)).otherwise(F.col("valid_to")).alias("valid_to"),
    )
    opening = moved.select(F.col(key).alias("_opening"))
    started = source.join(opening, source[key] == opening["_opening"], "left").where(
        F.col("_opening").isNotNull() | F.col(key).isNull()
    )
    return kept.unionByName(started.select(*_opened(data(source), F.col(key), run_time)))


def _moved_keys(
    opened: DataFrame, source: DataFrame, key: str, checked: Sequence[str]
) -> DataFrame:
    """Keys that need a new version or repeat: whether they have an open one, and their copies."""
    before = opened.select(key, F.struct(*checked).alias("_before"))
    after = source.groupBy(key).agg(
        F.first(F.struct(*checked)).alias("_after"), F.count(F.lit(1)).alias("_copies")
    )
    differs = reduce(
        lambda a, b: a | b,
        [~F.col(f"_before.{c}").eqNullSafe(F.col(f"_after.{c}")) for c in checked],
    )
    known = F.col("_before").isNotNull()
    return (
        after.join(before, key, "left")
        .where(~known | differs | (F.col("_copies") > 1))
        .select(key, known.alias("_known"), "_copies")
    )


def scd2_current(history: DataFrame) -> DataFrame:
    """Versions that are still open."""
    return history.where(F.col("valid_to").isNull())


def scd2_as_of(history: DataFrame, moment: datetime) -> DataFrame:
    """Versions valid at a moment."""
    at = _timestamp(moment)
    return history.where(
        (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (at < F.col("valid_to")))
    )


def history_exists(spark: SparkSession, path: str) -> bool:
    """Whether a run has been committed to the history under ``path``."""
    return files.exists(spark, f"{path}/{COMMITS}") and _last_commit(spark, path) is not None


def read_open(spark: SparkSession, path: str) -> DataFrame:
    """The open versions of the last committed run; closed ones are not read."""
    opened = _open_table(spark, path, _last_commit(spark, path)).drop(BUCKET, WRITTEN)
    if not files.exists(spark, f"{path}/{KEYLESS}"):
        return opened
    return opened.unionByName(_of_runs(spark, path, KEYLESS), allowMissingColumns=True)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions stored under ``path``, with every column that any of them has."""
    opened = read_open(spark, path)
    if not files.exists(spark, f"{path}/{CLOSED}"):
        return opened
    return opened.unionByName(_of_runs(spark, path, CLOSED), allowMissingColumns=True)


def _of_runs(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """Versions stored by run; what a run left that was not committed is not read."""
    stored = spark.read.option("mergeSchema", True).parquet(f"{path}/{folder}")
    runs = spark.read.schema(COMMIT).parquet(f"{path}/{COMMITS}").select(F.col("run").alias(RUN_COLUMN))
    stored = stored.withColumn(RUN_COLUMN, F.col(RUN_COLUMN).cast("string"))
    return stored.join(runs.distinct(), RUN_COLUMN, "left_semi").drop(RUN_COLUMN)


def _last_commit(spark: SparkSession, path: str) -> Row | None:
    commits = spark.read.schema(COMMIT).parquet(f"{path}/{COMMITS}")
    return commits.orderBy(F.desc("number")).first()


def _commit(spark: SparkSession, path: str, number: int, run: str, layout: StructType, written: Sequence[str]) -> None:
    """The one step that makes a run count: a row in the list of commits."""
    row = spark.createDataFrame([(number, run, layout.json(), list(written))], COMMIT)
    row.coalesce(1).write.mode("append").parquet(f"{path}/{COMMITS}")


def _attach(spark: SparkSession, name: str, path: str, layout: StructType, key: str, buckets: int) -> None:
    """A table over the folder of open versions, without any partition yet."""
    spark.sql(
        f"CREATE TABLE {name} ({layout.toDDL()}, {BUCKET} INT, {WRITTEN} STRING) USING parquet "
        f"PARTITIONED BY ({BUCKET}, {WRITTEN}) CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
        f"INTO {buckets} BUCKETS LOCATION '{path}/{OPEN}'"
    )


def _open_table(spark: SparkSession, path: str, commit: Row) -> DataFrame:
    """Open versions that have a key, as one commit names them: of each bucket one folder.

    The table is Spark's own bucketing, so a join by key needs no shuffle on this side.
    """
    name = f"open_versions_{uuid.uuid5(uuid.NAMESPACE_URL, f'{path} {commit.number} {commit.run}').hex}"
    if not spark.catalog.tableExists(name):
        layout = StructType.fromJson(json.loads(commit.layout))
        _attach(spark, name, path, layout, layout[0].metadata["key"], len(commit.written))
        parts = [f"PARTITION ({BUCKET}={b}, {WRITTEN}='{w}')" for b, w in enumerate(commit.written) if w]
        for at in range(0, len(parts), 500):
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(parts[at : at + 500])}")
    return spark.table(name)


def _write_open(spark: SparkSession, path: str, rows: DataFrame, key: str, buckets: int, label: str) -> None:
    """Write whole buckets of open versions beside those that are there."""
    name = f"new_versions_{uuid.uuid4().hex}"
    _attach(spark, name, path, rows.schema, key, buckets)
    placed = rows.withColumn(BUCKET, _bucket(key, buckets)).withColumn(WRITTEN, F.lit(label))
    placed.repartition(buckets, key).write.insertInto(name)
    spark.sql(f"DROP TABLE {name}")


def _bucket(key: str, buckets: int) -> Column:
    """The bucket in which Spark puts a key."""
    return F.pmod(F.hash(key), F.lit(buckets))


def _write_run(rows: DataFrame, path: str, folder: str, run: str) -> None:
    """Versions that are only ever added; what a stopped attempt of the same run left is replaced."""
    target = f"{path}/{folder}/{RUN_COLUMN}={run}"
    if not rows.isEmpty():
        rows.write.mode("overwrite").parquet(target)
    elif files.exists(rows.sparkSession, target):
        files.remove(rows.sparkSession, target)


def _drop_superseded(spark: SparkSession, path: str, older: Sequence[str], newer: Sequence[str]) -> None:
    """Remove what an earlier commit named and the last two do not, so their readers are not disturbed."""
    for bucket, (old, new) in enumerate(zip(older, newer)):
        if old and old != new:
            files.remove(spark, f"{path}/{OPEN}/{BUCKET}={bucket}/{WRITTEN}={old}")


def update_history(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: str,
    checked: Sequence[str],
    run_time: datetime,
    first: bool,
    buckets: int | None = None,
) -> None:
    """Load the source into the history stored under ``path``.

    Open versions lie in buckets by key. A run compares keys and checked columns bucket by bucket,
    without a shuffle of the history, and then reads and rewrites only the buckets in which a key
    moved; the files of the others stay. The number of buckets follows from the rows of the first
    load, or is given. Versions without a key never change, so they are only ever added, by run, and
    so are the versions that a run closes.

    New files stand beside the old ones until the last step, a commit that names the folder of every
    bucket. A run that stops before has changed nothing that is read; run it again. A run that is
    committed already is not loaded twice, and runs go forward in time. Folders are removed when two
    later commits do without them.
    """
    run = _utc(run_time).astimezone(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    label = f"{run}-{uuid.uuid4().hex[:8]}"
    last = _last_commit(spark, path) if history_exists(spark, path) else None
    if first != (last is None):
        raise ValueError(f"{path} holds {'a' if last else 'no'} history")
    has_key = F.col(key).isNotNull()
    if last is None:
        assert_unique(source.where(has_key), [key])
        if buckets is None:
            buckets = min(MAX_BUCKETS, max(MIN_BUCKETS, math.ceil(source.count() / ROWS_PER_BUCKET)))
        opened = scd2_init(source, key, run_time)
        _write_open(spark, path, opened.where(has_key), key, buckets, label)
        _write_run(opened.where(~has_key), path, KEYLESS, run)
        _commit(spark, path, 1, run, _layout(opened, key), [label] * buckets)
        return
    if run == last["run"]:
        return
    if run < last["run"]:
        raise ValueError(f"run {run} is earlier than the last one, {last['run']}")

    opened, buckets = _open_table(spark, path, last), len(last["written"])
    keyed = source.where(has_key).repartition(buckets, key)
    moved = _moved(opened, keyed, key, checked).withColumn(BUCKET, _bucket(key, buckets))
    touched = {row[BUCKET] for row in moved.select(BUCKET).distinct().collect()}  # at most the buckets
    old = opened.where(F.col(BUCKET).isin(sorted(touched))).drop(BUCKET, WRITTEN)
    merged = stage(_merged(old, source, moved, key, run_time), "merged-versions")
    still_open = F.col("valid_to").isNull()
    if touched:
        _write_open(spark, path, merged.where(still_open & has_key), key, buckets, label)
        _write_run(merged.where(~still_open), path, CLOSED, run)
    _write_run(merged.where(still_open & ~has_key), path, KEYLESS, run)
    written = [label if b in touched else w for b, w in enumerate(last["written"])]
    _commit(spark, path, last["number"] + 1, run, _layout(merged, key), written)
    before = spark.read.schema(COMMIT).parquet(f"{path}/{COMMITS}").where(F.col("number") == last["number"] - 1)
    for row in before.collect():  # one row
        _drop_superseded(spark, path, row["written"], last["written"])


def _layout(versions: DataFrame, key: str) -> StructType:
    """The columns of open versions; the first one carries the key's name."""
    layout = StructType.fromJson(json.loads(versions.schema.json()))
    layout[0].metadata = {**layout[0].metadata, "key": key}
    return layout
