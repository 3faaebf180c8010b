"""Readers for API dumps and spreadsheet exports, and the stamps put on their rows."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.functions.clean import missing_to_null
from salesloom.functions.names import header_names, table_name

# The members of an API response besides its records.
ENVELOPE_MEMBERS = ("success", "additional_data")
# Columns that catch cells beyond the header.
SURPLUS = tuple(f"_surplus_{i}" for i in range(8))


class HeaderMismatch(ValueError):
    """Files of one grid have different headers."""


def read_api_envelope(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType | None = None,
    lines: bool = False,
    records: str = "data",
    partitions: int | None = None,
) -> DataFrame:
    """Records of API dumps: ``{"data": [...]}``, a bare list, or one object per record.

    The form is told apart per file, so a folder may mix them. A file holds one JSON document,
    such as one page of a paged response, and is the unit of parallel work. With ``lines`` each
    line is a document and large files are split; that is the form for large dumps. A caller who
    knows that few whole documents hold many records may deal them out to ``partitions``. A schema
    is the layout of one record; fields beyond it are ignored. Without one Spark infers it.
    Malformed JSON is an error. A document without any field of a record, such as
    ``{"data": null}``, is no record.
    """
    reader = spark.read.option("multiLine", not lines).option("mode", "FAILFAST")
    if schema is None:
        found = reader.json(path)
        if records not in found.columns:
            return found
        record = found.schema[records].dataType.elementType
        reader = reader.schema(_document(record, records)) if _mixed(found, records) else reader
        documents = reader.json(path)
    else:
        record = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        documents = reader.schema(_document(record, records)).json(path)

    envelope = F.col(records).isNotNull()
    for member in ENVELOPE_MEMBERS:
        if member in documents.columns:
            envelope = envelope | F.col(member).isNotNull()
    bare = F.struct(
        *[
            (F.col(f"`{f.name}`") if f.name in documents.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in record
        ]
    )
    present = [F.col(f"`{f.name}`").isNotNull() for f in record if f.name in documents.columns]
    is_record = reduce(or_, present, F.lit(False))
    rows = F.when(envelope, F.col(records)).when(is_record, F.array(bare))
    found = documents.select(F.explode(rows).alias("_record")).select("_record.*")
    return found.repartition(partitions) if partitions else found


def _document(record: T.StructType, records: str) -> T.StructType:
    """Layout of a document that is either an envelope of records or one record."""
    clash = {records, *ENVELOPE_MEMBERS} & set(record.names)
    if clash:
        raise ValueError(f"record fields named like the envelope's: {sorted(clash)}")
    members = [T.StructField(m, T.StringType()) for m in ENVELOPE_MEMBERS]
    return T.StructType([*record, T.StructField(records, T.ArrayType(record)), *members])


def _mixed(found: DataFrame, records: str) -> bool:
    """Whether an inferred layout has record fields beside the envelope's members."""
    return bool(set(found.columns) - {records, *ENVELOPE_MEMBERS})


def read_grid(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    multi_line: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Spreadsheet export with a header row, every cell text and empty cells NULL.

    A repeated header gets its position. ``multi_line`` allows line breaks within cells, at the
    price of one task per file; turn it off for large exports without them, or deal the rows out
    to ``partitions``. A row with a cell beyond the header is an error, and so are files of one
    folder whose headers differ.
    """
    reader = _grid_reader(spark, sep, multi_line)
    first = reader.option("header", False).csv(path).first()
    if first is None:
        return spark.createDataFrame([], T.StructType([]))
    names = [f"c{i}" for i in range(len(first))]
    layout = T.StructType([T.StructField(c, T.StringType()) for c in (*names, *SURPLUS)])
    cells = reader.option("header", True).option("enforceSchema", True).schema(layout).csv(path)
    if len(cells.inputFiles()) > 1:
        _same_headers(spark, path, sep, multi_line, first)
    surplus = F.concat_ws(sep, *SURPLUS)
    beyond = F.concat(F.lit(f"a row has cells beyond the {len(first)} headers: "), surplus)
    texts = [F.when(F.col(c) != "", F.col(c)).alias(c) for c in names]
    # the check stands in the first cell, so no reader can skip it without skipping the cells
    texts[0] = F.when(surplus.rlike(f"[^{sep}]"), F.raise_error(beyond)).otherwise(texts[0]).alias("c0")
    grid = cells.select(*texts).toDF(*header_names(first))
    return grid.repartition(partitions) if partitions else grid


def _grid_reader(spark: SparkSession, sep: str, multi_line: bool):
    return spark.read.option("sep", sep).option("multiLine", multi_line).option("escape", '"')


def _same_headers(spark: SparkSession, path: str, sep: str, multi_line: bool, first: Row) -> None:
    """Refuse files whose first row differs from ``first``, by one query over all files.

    Each part of a file is a task and gives its first row; that of a file's first part with rows is
    the file's. The settings for that are those of a session of its own, so reads that run at the same
    time keep theirs. Files without rows have no header; a header without a name, at the end, counts
    as absent.
    """
    session = spark.newSession()
    part = spark.conf.get("spark.sql.files.maxPartitionBytes")
    # a part that costs as much to open as a task may read is never joined by another
    for setting in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        session.conf.set(setting, part)

    names = [f"c{i}" for i in range(len(first) + len(SURPLUS))]
    layout = T.StructType([T.StructField(c, T.StringType()) for c in names])
    rows = _grid_reader(session, sep, multi_line).option("header", False).schema(layout).csv(path)
    rows = rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        # the lower bits count the rows of a task
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("row"),
        *names,
    )
    firsts = rows.where("row = 0").select("file", "start", F.array(*names).alias("header"))
    headers = firsts.groupBy("file").agg(F.min_by("header", "start").alias("header"))
    expected = F.array(*[F.lit(c) for c in first], *[F.lit(None)] * len(SURPLUS)).cast("array<string>")
    # one row, whatever the number of files
    others = headers.where(F.col("header") != expected)
    found = others.agg(F.min(F.struct("file", "header")).alias("other")).first()["other"]
    if found:
        header = list(found["header"])
        while header and header[-1] is None:
            header.pop()
        raise HeaderMismatch(f"{found['file']} has the headers {header}, other files {list(first)}")


def stringify_all(df: DataFrame) -> DataFrame:
    """Every column as text; the words for a missing cell become NULL."""
    return df.select(*[missing_to_null(F.col(f"`{c}`")).alias(c) for c in df.columns])


def stamp(df: DataFrame, run_time: datetime, source: str | None = None) -> DataFrame:
    """Load time, the same for all rows of a run; for a sheet its name too, and time as ISO text."""
    moment = run_time if run_time.tzinfo else run_time.replace(tzinfo=timezone.utc)
    if source is None:
        return df.withColumn("_ingested_at", F.lit(moment).cast("timestamp"))
    return df.withColumns(
        {"_source_sheet": F.lit(table_name(source)), "_ingested_at": F.lit(moment.isoformat())}
    )
