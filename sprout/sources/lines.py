"""The labelled-line text format: ``<text><marker>`` with marker + - or 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import replace_output

# Line markers for label 1, -1 and unknown (0).
POSITIVE_MARK, NEGATIVE_MARK, UNKNOWN_MARK = "+", "-", "0"


def decode_marker(marker: Column) -> Column:
    return (F.when(marker == POSITIVE_MARK, F.lit(1))
            .when(marker == NEGATIVE_MARK, F.lit(-1)).otherwise(F.lit(0)))


def encode_marker(label: Column) -> Column:
    return (F.when(label == 1, F.lit(POSITIVE_MARK))
            .when(label == -1, F.lit(NEGATIVE_MARK)).otherwise(F.lit(UNKNOWN_MARK)))


def parse_lines(lines: DataFrame, value: str = "value", strip_chars: int = 1,
                keep=()) -> DataFrame:
    """(keep..., text, label) from marked lines.

    The last character is the marker; ``strip_chars`` characters are removed
    from the end to get the text (1; the notebook variant assumes 3). An
    empty line gives ("", 0); an unmarked line still loses its last char.
    """
    v = F.col(value)
    text = F.expr(f"substring(`{value}`, 1, length(`{value}`) - {int(strip_chars)})")
    return lines.select(*keep, text.alias("text"),
                        decode_marker(F.substring(v, -1, 1)).alias("label"))


def encode_labelled(sents: DataFrame, keep=()) -> DataFrame:
    """(keep..., value) with value = text + marker."""
    return sents.select(*keep, F.concat(F.col("text"), encode_marker(F.col("label"))).alias("value"))


def with_line_index(df: DataFrame, name: str = "sent_id") -> DataFrame:
    """Add a dense 0-based index to rows scanned from files, in file order.

    Files are ordered by path, their blocks by start, rows by position in the
    block; the index doesn't depend on how the scan was split or scheduled.
    One small aggregation counts rows per block; its running totals are joined
    back, so nothing grows on the driver.
    """
    tagged = df.select("*", F.col("_metadata.file_path").alias("_file"),
                       F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_mid"))
    blocks = tagged.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_rows"), F.min("_mid").alias("_first"))
    # One row per file block meets in this window, not one per line.
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("_file", "_block", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_off"))
    return (tagged.join(offsets, ["_file", "_block"])
            .select((F.col("_off") + F.col("_mid") - F.col("_first")).alias(name), *df.columns))


def read_labelled_lines(spark: SparkSession, path: str, strip_chars: int = 1,
                        index: bool = False) -> DataFrame:
    """(text, label) per line; with ``index``, (sent_id, text, label) by line position.

    ``path`` may be a file or a folder of files.
    """
    lines = spark.read.text(path)
    if index:
        return parse_lines(with_line_index(lines), "value", strip_chars, keep=("sent_id",))
    return parse_lines(lines, "value", strip_chars)


def one_line(text: Column) -> Column:
    """Text for a line-based file: each line break becomes a space."""
    return F.regexp_replace(text, r"[\r\n]", " ")


def write_labelled_lines(sents: DataFrame, path: str) -> None:
    """One line per row; line breaks inside a text become spaces, a NULL text is an empty one.

    An output already there is replaced once the new one is complete.
    """
    lines = encode_labelled(sents.withColumn("text", one_line(F.coalesce("text", F.lit("")))))
    replace_output(sents.sparkSession, path, lambda staging: lines.write.text(staging))
