"""CSV whose quoted fields contain line breaks, read in splits.

Whether a line break ends a record depends on whether it stands inside quotes, so on all quotes
before it. One pass counts the quotes of each split; running sums over the splits tell in which
state each begins. A second pass then puts the lines of every split together to records, each on
its own. A record that crosses a border leaves a fragment on either side, and only these are
brought together.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.sources.tables import stage_table

WHOLE, FRAGMENT = 0, 1
_PIECES = "file string, split long, number long, kind int, text string"


def _quotes(c):
    return F.length(c) - F.length(F.replace(c, F.lit('"'), F.lit("")))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, the start of their split, and their order in it."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("number"))


def _assemble(batches):
    """Records of each split. A split that begins inside quotes begins with a fragment; one that
    ends inside them ends with one."""
    place, inside, kept, first, fragment = None, False, [], 0, False
    out: list[tuple] = []
    held = 0

    def close(kind):
        out.append((*place, first, kind, "\n".join(kept)))

    def batch_of():
        columns = list(zip(*out))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()))],
            ["file", "split", "number", "kind", "text"])

    for batch in batches:
        for value, file, split, number, odd, begins in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, split) != place:
                if kept:
                    close(FRAGMENT)
                place, inside, kept, fragment = (file, split), begins, [], begins
            if not kept:
                first = number
            kept.append(value)
            held += len(value)
            inside ^= odd
            if not inside:
                close(FRAGMENT if fragment else WHOLE)
                kept, fragment = [], False
            if len(out) >= 10_000 or (out and held > 1 << 24):
                yield batch_of()
                out.clear()
                held = 0
    if kept:
        close(FRAGMENT)
    if out:
        yield batch_of()


def records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, split, number, text)``: one row per record, quotes and inner line breaks kept.

    ``number`` orders the records of a split. Blank lines outside quotes are left out, and a
    carriage return before a line break goes with it. A last record whose quotes never close
    reaches to the end of its file.
    """
    lines = _lines(spark, path).withColumn("odd", _quotes(F.col("value")) % 2 == 1)
    sums = lines.groupBy("file", "split").agg((F.count_if("odd") % 2).alias("odds"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    begins = (F.coalesce(F.sum("odds").over(before), F.lit(0)) % 2 == 1).alias("begins")
    # One row per split: Spark broadcasts them by their size, or shuffles, and the sort below
    # brings the lines of a split back in order then.
    states = stage_table(sums.select("file", "split", begins), "splits")
    ordered = lines.join(states, ["file", "split"]).sortWithinPartitions("file", "split", "number")
    pieces = stage_table(
        ordered.select("value", "file", "split", "number", "odd", "begins").mapInArrow(
            _assemble, _PIECES), "records")
    return _whole(pieces).filter(F.col("text") != "")


def _whole(pieces: DataFrame) -> DataFrame:
    """Whole records, and those put together of fragments (two per split at most)."""
    whole = pieces.filter(F.col("kind") == WHOLE)
    broken = pieces.filter(F.col("kind") == FRAGMENT)
    in_file = Window.partitionBy("file").orderBy("split", "number")
    odd = _quotes(F.col("text")) % 2
    # A fragment that opens a record comes where all fragments before it have closed theirs.
    opened = F.coalesce(
        F.sum(odd).over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2 == 0
    numbered = broken.withColumn("opens", opened.cast("int")).withColumn(
        "record", F.sum("opens").over(in_file.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct("split", "number", "text")))
    joined = numbered.groupBy("file", "record").agg(parts.alias("parts")).select(
        "file", F.col("parts")[0]["split"].alias("split"), F.col("parts")[0]["number"].alias("number"),
        F.array_join(F.col("parts")["text"], "\n").alias("text"))
    names = ("file", "split", "number", "text")
    every = whole.select(*names).unionByName(joined.select(*names))
    return every.withColumn("text", F.regexp_replace("text", r"\r$", ""))
