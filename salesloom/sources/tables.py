"""Table sinks: layers as databases, refresh in full or by changed folders, and the raw zone."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from salesloom.functions.names import qualified_name
from salesloom.operators.changes import digests
from salesloom.sources import files

#: Digests of a table's folders, beside its rows.
DIGESTS = "digests"
NOTE = "number INT, folders STRING"


def ensure_database(spark: SparkSession, layer: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer.strip()}`")


def replace_table(
    df: DataFrame,
    layer: str,
    table: str,
    partition_by: Sequence[str] = (),
    keep_if_empty: bool = False,
) -> int:
    """Full refresh of ``layer.table``; gives the number of rows written.

    The rows go to whichever of two folders the table does not point at, and only a finished
    write moves the table over, by changing its location. A failed load leaves the old rows in
    place, the table is never absent, and it may be computed from its own old rows. With
    ``keep_if_empty`` a refresh without rows leaves the table alone. A table whose columns or
    partitioning changed is made anew. ``partition_by`` columns make folders that reads can skip.
    """
    spark = df.sparkSession
    ensure_database(spark, layer)
    name = qualified_name(layer, table)
    home = spark.catalog.getDatabase(layer.strip()).locationUri
    folders = [f"{home}/{table}/{side}" for side in ("a", "b")]
    current = _location(spark, name)
    target = folders[1] if current and current.endswith("/a") else folders[0]
    files.remove(spark, f"{home}/{table}/{DIGESTS}")  # what they say of the table ends here

    df = df.select(*[c for c in df.columns if c not in partition_by], *partition_by)
    if partition_by:  # few files per folder; a folder with many rows is split all the same
        df = df.hint("rebalance", *partition_by)
    counted = Observation()
    rows = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
    written = counted.get["rows"]
    if keep_if_empty and not written:
        return 0
    if current and _layout(spark, name) == (_types(df.schema), list(partition_by)):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{target}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        _create(spark, name, df.schema, partition_by, target)
    spark.catalog.refreshTable(name)
    return written


def replace_changed(df: DataFrame, layer: str, table: str, month: str) -> list[str]:
    """Bring ``layer.table`` up to ``df`` by the folders of those months whose rows differ.

    Gives the months that were written or removed, as text. Each month's digest is kept beside the
    table and compared with that of ``df``, so the rows of other months are computed once, to be
    hashed, and neither shuffled nor written; their files stay. A table without digests, or whose
    columns changed, is refreshed in full. The rows are computed twice, so stage what is dear and
    small. ``month`` is a date column; months and digests come to the driver, as few as the folders.

    Spark replaces the folders when all their files are written, each by a rename. Before that the
    months are noted as in doubt, and the digests after it; so a refresh that stops on the way is made
    good by the next one, whatever its rows are. One refresh of a table at a time.
    """
    spark = df.sparkSession
    if not isinstance(df.schema[month].dataType, DateType):
        raise ValueError(f"{month} is no date")
    ensure_database(spark, layer)
    name = qualified_name(layer, table)
    notes = f"{spark.catalog.getDatabase(layer.strip()).locationUri}/{table}/{DIGESTS}"
    df = df.select(*[c for c in df.columns if c != month], month)
    found = digests(df, month).collect()
    now = {_folder(month, r["value"]): r["digest"] for r in found}
    location = _location(spark, name)
    known = location and _layout(spark, name) == (_types(df.schema), [month])
    last = _last_note(spark, notes) if known and files.exists(spark, notes) else None
    if last is None:
        replace_table(df, layer, table, [month])
        _note(spark, notes, 1, now)
        return sorted(f.partition("=")[2] for f in now)

    number, before = last
    gone = before.keys() - now.keys()
    differ = {f for f, digest in now.items() if digest != before.get(f)}
    if not gone and not differ:
        return []
    _note(spark, notes, number + 1, before | dict.fromkeys(gone | differ))
    if differ:
        months = [r["value"] for r in found if _folder(month, r["value"]) in differ]
        wanted = F.col(month).isin([m for m in months if m is not None])
        if None in months:
            wanted = F.col(month).isNull() | wanted
        rows = df.where(wanted).hint("rebalance", month).write.mode("overwrite")
        rows.option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(location)
    for folder in gone:
        files.remove(spark, f"{location}/{folder}")
    _note(spark, notes, number + 2, now)
    spark.catalog.refreshTable(name)
    return sorted(f.partition("=")[2] for f in gone | differ)


def _folder(column: str, value: date | None) -> str:
    """The folder that Spark gives a date."""
    return f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value.isoformat()}"


def _note(spark: SparkSession, path: str, number: int, folders: dict[str, str | None]) -> None:
    """Add a row of folders and digests; no digest means that the folder's rows are in doubt."""
    row = spark.createDataFrame([(number, json.dumps(folders))], NOTE)
    row.coalesce(1).write.mode("append").parquet(path)


def _last_note(spark: SparkSession, path: str) -> tuple[int, dict[str, str | None]] | None:
    row = spark.read.schema(NOTE).parquet(path).orderBy(F.desc("number")).first()
    return row and (row["number"], json.loads(row["folders"]))


def _create(
    spark: SparkSession, name: str, schema: StructType, partition_by: Sequence[str], path: str
) -> None:
    """A table over a folder. Partitions are found in its files, so they move with its location."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    statement = f"CREATE TABLE {name} ({columns}) USING parquet {parts} LOCATION '{path}'"
    if not partition_by:  # loads that run at the same time leave the setting alone
        spark.sql(statement)
        return
    setting = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(setting, "true")
    spark.conf.set(setting, "false")
    try:
        spark.sql(statement)
    finally:
        spark.conf.set(setting, before)


def _types(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def _layout(spark: SparkSession, name: str) -> tuple[list[tuple[str, str]], list[str]]:
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    return _types(spark.table(name).schema), parts


def _location(spark: SparkSession, name: str) -> str | None:
    """Folder that a table points at, if it exists."""
    if not spark.catalog.tableExists(name):
        return None
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return details.where("col_name = 'Location'").first()["data_type"]


def replace_view(df: DataFrame, name: str) -> DataFrame:
    """Register a lazy table under a name."""
    df.createOrReplaceTempView(name)
    return df


def land(
    df: DataFrame,
    root: str,
    entity: str,
    day: date,
    keep_if_empty: bool = False,
    compression: str | None = None,
) -> str | None:
    """Write records as line-JSON to the raw zone, one folder per entity and load date.

    A second load on the same day replaces that day's folder only, once it is written in full
    beside it; a load that fails leaves the folder as it was. With ``keep_if_empty`` so does a
    load without records, and None is returned. ``compression`` is a codec that Spark knows. With
    ``gzip`` the files take a tenth of the place or so, but each is read by one task, so it is for
    loads of many tasks, each of which writes a file.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/raw/crm/{entity}/ingest_date={day.isoformat()}"
    fresh = files.beside(path)
    counted = Observation()
    try:
        df.observe(counted, F.count(F.lit(1)).alias("rows")).write.json(fresh, compression=compression)
    except Exception:
        files.remove(spark, fresh)
        raise
    if keep_if_empty and not counted.get["rows"]:
        files.remove(spark, fresh)
        return None
    files.swap_in(spark, fresh, path)
    return path
