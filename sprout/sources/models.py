"""Model tables: Parquet (ngram, fid, weight, n) and the legacy text form.

The legacy form has one ``(ngram,weight)`` line per feature, sorted by
weight descending; the feature id is the line position and N is the word
count of an N-gram.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import replace_output
from .lines import with_line_index


def write_model(model_frame: DataFrame, path: str) -> None:
    """Replace the model at ``path`` once the new one is complete."""
    replace_output(model_frame.sparkSession, path, lambda staging: model_frame.write.parquet(staging))


def read_model(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("ngram", "fid", "weight", "n")


def write_legacy_model(model_frame: DataFrame, path: str) -> None:
    """``(ngram,weight)`` lines by weight descending, then N-gram; one file of m lines.

    Weights that differ only by rounding noise count as equal in the order.
    """
    line = F.concat(F.lit("("), F.col("ngram"), F.lit(","), F.col("weight").cast("string"), F.lit(")"))
    lines = model_frame.orderBy(F.round("weight", 12).desc(), F.col("ngram")).select(line.alias("value")).coalesce(1)
    replace_output(model_frame.sparkSession, path, lambda staging: lines.write.text(staging))


def read_legacy_model(spark: SparkSession, path: str) -> DataFrame:
    """Parse legacy lines back to (ngram, fid, weight, n).

    The id is the line's position in the file.
    """
    raw = with_line_index(spark.read.text(path), name="fid")
    parsed = raw.select(
        F.col("fid").cast("int").alias("fid"),
        F.regexp_extract("value", r"^\((.*),([^,]*)\)$", 1).alias("ngram"),
        F.regexp_extract("value", r"^\((.*),([^,]*)\)$", 2).cast("double").alias("weight"))
    return parsed.select(
        "ngram", "fid", "weight",
        F.size(F.split("ngram", " ")).alias("n"))
