"""Readers with a row id, and writers.

Paths may be anything Spark's file systems understand; nothing is read or written by the
driver itself.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenure.errors import DataQualityError
from tenure.operators import findings as Q
from tenure.operators.ordered import positions
from tenure.operators.staging import staged
from tenure.schemas import require_columns
from tenure.sources.files import file_system

READ = "read"
RAGGED_ROW, CUT_QUOTE = "ragged_row", "cut_quote"

# How the files are written.
_CSV = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"'}
#: No text holds this character (it is none), so it keeps a line in one piece.
_NOWHERE = "\uffff"
_RAW = "_raw"
# A well-formed quoted field, from its separator on.
_QUOTED = '(^|,)"([^"]|"")*"(?=,|$)'


class Parsed(NamedTuple):
    """A text table after its one pass: usable rows, and rows that are not, as they stand in the file."""

    rows: DataFrame
    #: (row_id, reason, raw); None for a stored table, which has none.
    bad: DataFrame | None


def _reason(raw: Column, fields: int) -> Column:
    """Why a line is no row: a quote that does not end in it, or more fields than the header."""
    rest = F.when(raw.contains('"'), F.regexp_replace(raw, _QUOTED, "$1")).otherwise(raw)
    found = F.length(rest) - F.length(F.replace(rest, F.lit(","), F.lit(""))) + 1
    quotes = F.length(rest) - F.length(F.replace(rest, F.lit('"'), F.lit("")))
    # What comes after a cut quote ends in one.
    cut = rest.rlike('(^|,)"') | ((found < fields) & (quotes % 2 == 1))
    return F.when(cut, CUT_QUOTE).when(found > fields, RAGGED_ROW)


def parse_csv(
    spark: SparkSession,
    path: str,
    columns: tuple[str, ...],
    table: str,
    dense_ids: bool = False,
    multiline: bool = False,
) -> Parsed:
    """All columns as text, padding kept, plus ``row_id`` in file order; and the bad rows.

    The file is read once: lines are split, judged and written, and both results are scans of what
    was written. ``path`` is a file, a compressed file or a folder of files, which count in the
    order of their names. The header decides the columns, so tables may order them differently and
    carry more of them. A row with fewer fields lacks the last ones. A row with more fields than
    the header is ``ragged_row``; a quoted field that does not end in its line is ``cut_quote``, and
    so is what follows it. Lines are what splits a large file; ``multiline`` reads line breaks
    inside quotes, which gives each file to one task. ``row_id`` is increasing; ``dense_ids`` makes
    it 0, 1, 2, ... over usable and bad rows.
    """
    try:
        header = spark.read.options(**_CSV, header=True, inferSchema=False, multiLine=multiline).csv(path)
        require_columns(header, columns, table)
        names = header.columns
        files = len(header.inputFiles())
        if multiline:
            # Rows that do not fit come with their text.
            kind = T.StructType([*header.schema.fields, T.StructField(_RAW, T.StringType())])
            lines = spark.read.options(**_CSV, header=True, multiLine=True, columnNameOfCorruptRecord=_RAW).schema(kind).csv(path)
            fields = {c: F.col(_quoted(c)) for c in columns}
        else:
            whole = {"sep": _NOWHERE, "quote": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
            lines = spark.read.options(**whole, header=True).schema(f"{_RAW} string").csv(path)
            ddl = ", ".join(f"{_quoted(c)} string" for c in names)
            split = F.from_csv(_RAW, ddl, _CSV)
            fields = {c: split.getField(c) for c in columns}
        reason = _reason(F.col(_RAW), len(names))
        rows = lines.select(
            *[value.alias(c) for c, value in fields.items()],
            reason.alias("_reason"),
            F.when(reason.isNotNull(), F.col(_RAW)).alias(_RAW),
            F.monotonically_increasing_id().alias("row_id"),
            F.col("_metadata.file_path").alias("_file"),
        )
        rows = staged(rows, f"parsed_{table}")
    except (AnalysisException, PySparkException) as error:
        raise DataQualityError(f"Failed to read {path}: {error}") from error
    if files > 1 or dense_ids:
        rows = positions(rows, ["_file", "row_id"], "_position").drop("row_id").withColumnRenamed("_position", "row_id")
    return Parsed(
        rows.where("_reason IS NULL").select("row_id", *columns),
        rows.where("_reason IS NOT NULL").select("row_id", F.col("_reason").alias("reason"), F.col(_RAW).alias("raw")),
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def bad_row_findings(bad: DataFrame, table: str) -> DataFrame:
    """Bad rows as findings, with their text as it stands in the file."""
    shown = {RAGGED_ROW: "has more fields than the header", CUT_QUOTE: "has a quote that does not end in its line"}
    rows = bad.withColumn("customer_id", F.lit(None).cast("string"))
    rules = [
        Q.Rule(rule, F.col("reason") == rule, Q.DROPPED, F.col("raw"), F.format_string(f"A row of {table} {why} - skipping: %s", F.col("raw")))
        for rule, why in shown.items()
    ]
    return Q.findings(rows, f"{READ}_{table}", rules)


def require_no_bad_rows(parsed: Parsed, path: str) -> None:
    """Raise with the number of bad rows of each kind."""
    counted = {r["reason"]: r["count"] for r in parsed.bad.groupBy("reason").count().collect()} if parsed.bad is not None else {}
    if counted:
        kinds = {RAGGED_ROW: "have more fields than the header", CUT_QUOTE: "have a line break inside quotes, which needs multiline=True"}
        said = "; ".join(f"{n} rows {kinds[rule]}" for rule, n in sorted(counted.items()))
        raise DataQualityError(f"Failed to read {path}: {said}")


def read_csv(
    spark: SparkSession,
    path: str,
    columns: tuple[str, ...],
    table: str,
    dense_ids: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """The rows of ``parse_csv``; a bad row raises before any is used."""
    parsed = parse_csv(spark, path, columns, table, dense_ids, multiline)
    require_no_bad_rows(parsed, path)
    return parsed.rows


def file_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder on any file system; 0 where it does not exist."""
    system, target = file_system(spark, path)
    return system.getContentSummary(target).getLength() if system.exists(target) else 0


def read_parquet(spark: SparkSession, path: str, columns: tuple[str, ...], table: str) -> DataFrame:
    """A stored table; its ``row_id`` is used if present, else one is assigned."""
    try:
        stored = spark.read.parquet(path)
    except (AnalysisException, PySparkException) as error:
        raise DataQualityError(f"Failed to read {path}: {error}") from error
    require_columns(stored, columns, table)
    if "row_id" not in stored.columns:
        stored = stored.withColumn("row_id", F.monotonically_increasing_id())
    return stored


def _is_csv(path: str, fmt: str | None) -> bool:
    return fmt == "csv" or fmt is None and path.endswith((".csv", ".csv.gz", ".csv.bz2"))


def parse_table(
    spark: SparkSession,
    path: str,
    columns: tuple[str, ...],
    table: str,
    fmt: str | None = None,
    multiline: bool = False,
) -> Parsed:
    """``fmt`` is csv or parquet; without it, CSV for names in .csv, .csv.gz and .csv.bz2."""
    if _is_csv(path, fmt):
        return parse_csv(spark, path, columns, table, multiline=multiline)
    return Parsed(read_parquet(spark, path, columns, table), None)


def read_table(
    spark: SparkSession,
    path: str,
    columns: tuple[str, ...],
    table: str,
    dense_ids: bool = False,
    fmt: str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """The same, where a bad row raises."""
    if _is_csv(path, fmt):
        return read_csv(spark, path, columns, table, dense_ids, multiline)
    return read_parquet(spark, path, columns, table)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = (),
    mode: str = "overwrite",
) -> None:
    """Write a folder, creating its parents."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True).option("emptyValue", "").option("nullValue", "")
    writer.format(fmt).save(path)


def require_rows(df: DataFrame, what: str) -> None:
    """Raise when a table is empty."""
    if df.isEmpty():
        raise DataQualityError(f"No valid {what} found")
