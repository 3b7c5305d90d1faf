"""Landed files: probe samples, sheets, storage reports, service snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsmetrics.operators.storage import split_lines
from opsmetrics.schemas import BROKEN, PROBE_SAMPLE, SERVICE_SNAPSHOT


def _with_broken(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField(BROKEN, T.StringType())])


def parsed_json(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """(value) of JSON texts -> the fields of `schema` and `broken`, which holds
    the text if it cannot be read and is missing otherwise. Blank texts are
    passed over."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    parsed = F.from_json("value", _with_broken(schema), options)
    kept = lines.filter(F.trim("value") != "")
    return kept.select(F.coalesce(parsed, F.struct(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema], F.col("value").alias(BROKEN)
    )).alias("_parsed")).select("_parsed.*")


def read_headed_csv(
    spark: SparkSession, path: str, partition: str | None = None, broken: bool = False
) -> DataFrame:
    """CSV files as text columns, named by their header; with `broken`, lines of
    another length than the header are kept in that column.

    All files must have the header of the first: one with other columns, or
    the same in another order, fails the query instead of swapping cells.
    """
    reader = spark.read.option("header", True)
    names = [c for c in reader.csv(path).columns if c != partition]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if broken:
        schema = _with_broken(schema)
    if partition:
        schema = schema.add(partition, T.StringType())
    return (
        reader.schema(schema).option("enforceSchema", False)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN)
        # Lines and headers are judged as a whole, whatever columns are asked for.
        .option("columnPruning", False).csv(path)
    )


def read_probe_lines(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """One row of text fields per line and `broken`, the line itself where it
    cannot be read (then the fields do not count).

    JSON lines, or CSV with a header that names the columns in any order; a
    column that the header lacks fails.
    """
    names = [*PROBE_SAMPLE.fieldNames(), BROKEN]
    if fmt == "json":
        return parsed_json(spark.read.text(path), PROBE_SAMPLE).select(*names)
    lines = read_headed_csv(spark, path, broken=True)
    if missing := [n for n in names if n not in lines.columns]:
        raise ValueError(f"the samples have no column {', '.join(missing)}")
    return lines.select(*names)


def whole(lines: DataFrame) -> DataFrame:
    """The rows that could be read, without `broken`."""
    return lines.filter(F.col(BROKEN).isNull()).drop(BROKEN)


def read_probe_samples(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """One row of text fields per host and probe. An unreachable host is a row like
    any other. Lines that cannot be read are in `read_probe_lines`."""
    return whole(read_probe_lines(spark, path, fmt))


def read_snapshot_sheets(spark: SparkSession, sheets: Mapping[str, str] | str) -> DataFrame:
    """The sheets of a workbook, each saved as CSV, as one table of text with a
    `sheet` column. Blanks around header names are dropped.

    A mapping of names to paths may hold sheets with different columns; one
    that a sheet lacks is missing there. A folder of `sheet=NAME` folders is
    read at once, and all its files must have one header.
    """

    def stripped(df: DataFrame) -> DataFrame:
        # Cells keep their blanks: only the header is repaired.
        return df.toDF(*[c.strip() for c in df.columns])

    if isinstance(sheets, str):
        return stripped(read_headed_csv(spark, sheets, partition="sheet"))
    parts = [
        stripped(read_headed_csv(spark, path)).withColumn("sheet", F.lit(name))
        for name, path in sheets.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_text_reports(spark: SparkSession, path: str) -> DataFrame:
    """(report_id, txt): one row per file, for `scan_report`."""
    return (
        spark.read.text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("report_id"), F.col("value").alias("txt"))
    )


def read_report_lines(spark: SparkSession, path: str) -> DataFrame:
    """(report_id, piece, line_no, line), for `scan_report_lines`.

    Reads splits of a file side by side, so a file may be of any size. `piece`
    is where the split starts in the file and `line_no`, a row and a part of
    it, grows within it; it is not the number of the line in the file. Rows are
    split again, since reports have more line ends than Spark's reader knows.
    """
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("report_id"),
        F.col("_metadata.file_block_start").alias("piece"),
        F.monotonically_increasing_id().alias("row"),
        F.posexplode(split_lines(F.col("value"))).alias("part", "line"),
    )
    return rows.select("report_id", "piece", F.struct("row", "part").alias("line_no"), "line")


def flatten_services(df: DataFrame, items: str = "items", keep: Sequence[str] = ()) -> DataFrame:
    """(service_name, health_status) of every listed service, after the columns
    to `keep`; a document with an absent or empty list gives no row."""
    return df.select(*keep, F.explode(items).alias("_service")).select(
        *keep,
        F.col("_service.displayName").alias("service_name"),
        F.col("_service.healthSummary").alias("health_status"),
    )


def read_service_documents(
    spark: SparkSession, path: str, one_per_line: bool = False
) -> DataFrame:
    """(items, broken) of JSON documents: one per file, or one per line, which lets
    Spark split large files. `broken` holds a document that cannot be read."""
    return parsed_json(spark.read.text(path, wholetext=not one_per_line), SERVICE_SNAPSHOT)


def read_service_snapshots(
    spark: SparkSession, path: str, one_per_line: bool = False
) -> DataFrame:
    """Services of JSON documents, of which a broken one fails the query."""
    documents = read_service_documents(spark, path, one_per_line)
    message = F.concat(F.lit("malformed document: "), F.substring(BROKEN, 1, 200))
    checked = F.when(F.col(BROKEN).isNotNull(), F.raise_error(message)).otherwise(F.col("items"))
    return flatten_services(documents.select(checked.alias("items")))
