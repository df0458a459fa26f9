"""Raw sales files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.text import na_to_null
from tallyline.schemas import MALFORMED, RAW_SALES_COLUMNS
from tallyline.sources.quoted_csv import records
from tallyline.sources.tables import stage_table


def read_sales_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Read a headed CSV as text, with the usual "no value" tokens as NULL.

    Columns are named from the header, so a missing column is seen by ``require_columns``.
    Spark binds the columns of several files by position; each file's header is therefore
    checked against the first one's, and a file with other columns, or the same in another
    order, fails the read. A missing path is Spark's own ``AnalysisException``.
    ``multiline`` allows line breaks inside quotes; a file is read in splits then too
    (``quoted_csv``).

    A row with more or fewer fields than the header has its whole line in the column
    ``MALFORMED``, which ``ingest`` rejects; that column is NULL for all others.
    """
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("quote", '"')
        .option("escape", '"')
    )
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*names, MALFORMED)])
    if multiline:
        raw = _parsed(records(spark, path), names, schema)
        return raw.select(*(na_to_null(F.col(f"`{c}`")).alias(c) for c in names), MALFORMED)
    raw = (
        reader.schema(schema)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        # A pruned read does not see how many fields a row has.
        .option("columnPruning", False)
        .csv(path)
    )
    return raw.select(*(na_to_null(F.col(f"`{c}`")).alias(c) for c in names), MALFORMED)


def _parsed(lines: DataFrame, names: list[str], schema: T.StructType) -> DataFrame:
    """Records to columns; the first record of each file is its header and must be the same."""
    options = {
        "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED,
        "maxCharsPerColumn": "-1",
    }
    spark = lines.sparkSession
    first = lines.groupBy("file").agg(
        F.min_by("text", F.struct("split", "number")).alias("header"),
        F.min(F.struct("split", "number")).alias("at"))
    first = stage_table(first, "headers")
    for row in first.select("header").distinct().limit(2).collect():
        found = spark.createDataFrame([(row.header,)], "t string").select(
            F.from_csv("t", ", ".join(f"c{i} string" for i in range(len(names))), options)).first()[0]
        if list(found) != names:
            raise ValueError(f"CSV header does not conform to the first file's: {row.header}")
    headers = first.select("file", F.col("at.split").alias("split"), F.col("at.number").alias("number"))
    rows = lines.join(headers, ["file", "split", "number"], "left_anti")
    return rows.select(F.from_csv("text", schema.simpleString()[7:-1].replace(":", " "), options).alias("r")).select("r.*")


def require_columns(df: DataFrame, required: Iterable[str] = RAW_SALES_COLUMNS) -> DataFrame:
    """Raise before any job runs when a column is missing; extra columns are let through."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {sorted(missing)}")
    return df
