"""Score arriving text against a saved model.

A model within the lookup bound (at most m N-grams) is collected once and compiled into
the plan as a constant lookup, so each micro-batch is a narrow projection: no state, no
join, no shuffle. A new model means a new query (restart from the same checkpoint to keep
exactly-once output).

A larger model is joined, which a stream can't do without state. Its arrivals are taken
in runs instead (:func:`score_arrivals`): the stream copies what is new to a table with the
file sink's exactly-once log, and a batch job joins the rows of files that no run has
scored yet. The model is never collected, and a run that is repeated replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..defaults import MAX_LOOKUP_KEYS
from ..functions.stats import sign_marker
from ..operators.scoring import model_score
from ..operators.vocab import tokenized
from ..plans.batch import load_model, score_batch
from ..session import path_exists
from ..sources.fixtures import bounded


def score_stream(stream: DataFrame, model_frame: DataFrame, keys, text: str = "text") -> DataFrame:
    """(keys..., score, label) for a streaming (or batch) DataFrame."""
    keys = list(keys)
    if not stream.isStreaming:
        return score_batch(stream, model_frame, keys, text, max_lookup_keys=MAX_LOOKUP_KEYS)
    model = load_model(model_frame, limit=MAX_LOOKUP_KEYS)
    if model is None:
        raise ValueError("a model above the lookup bound is joined in runs: use score_arrivals")
    rows = tokenized(stream, model.n, text=text, keep=keys)
    scored = rows.select(*keys, model_score(F.col("ng"), model).alias("score"))
    return scored.select(*keys, "score", sign_marker(F.col("score")).alias("label"))


def score_arrivals(stream: DataFrame, model_frame: DataFrame, sink_path: str, keys, checkpoint: str,
                   text: str = "text") -> StreamingQuery:
    """One run: score all that has arrived since the last one into ``sink_path/run=<k>``.

    ``checkpoint`` holds the arrivals, the stream's log and the list of files that each
    finished run has scored. A run that fails is done again under its own number, over
    the same files or more, and overwrites what it has written. Returns the (ended) query
    that took the arrivals.
    """
    keys, spark, base = list(keys), stream.sparkSession, checkpoint.rstrip("/")
    query = (stream.select(*keys, text).writeStream.format("parquet").outputMode("append")
             .option("path", f"{base}/arrived").option("checkpointLocation", f"{base}/stream")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if not path_exists(spark, f"{base}/arrived/_spark_metadata"):
        return query  # nothing has ever arrived
    arrived = spark.read.schema(stream.select(*keys, text).schema).parquet(f"{base}/arrived").select(
        "*", F.col("_metadata.file_path").alias("_file"))
    fresh, run = arrived.select("_file").distinct(), 0
    if path_exists(spark, f"{base}/runs"):
        done = spark.read.parquet(f"{base}/runs")
        fresh = fresh.join(bounded(done.select("_file")), "_file", "left_anti")
        run = done.agg(F.max("run")).first()[0] + 1
    if not fresh.limit(1).count():
        return query
    rows = arrived.join(bounded(fresh), "_file", "left_semi")
    scored = score_batch(rows, model_frame, keys, text, max_lookup_keys=MAX_LOOKUP_KEYS)
    scored.write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/run={run}")
    # Recorded last: until then the run counts as not done.
    fresh.select(F.lit(run).alias("run"), "_file").write.mode("append").parquet(f"{base}/runs")
    return query


def _start(stream: DataFrame, model_frame: DataFrame, sink_path: str, keys, checkpoint: str, text: str,
           trigger_once: bool) -> StreamingQuery:
    if load_model(model_frame, limit=MAX_LOOKUP_KEYS) is None:
        if not trigger_once:
            raise ValueError("a model above the lookup bound is scored in runs: set trigger_once and call again for more")
        return score_arrivals(stream, model_frame, sink_path, keys, checkpoint, text)
    writer = (score_stream(stream, model_frame, keys, text).writeStream.format("parquet").outputMode("append")
              .option("path", sink_path).option("checkpointLocation", checkpoint))
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_scoring(spark: SparkSession, source_path: str, schema: str, model_frame: DataFrame,
                  sink_path: str, keys, checkpoint: str, text: str = "text",
                  trigger_once: bool = False) -> StreamingQuery:
    """Parquet folder in, scored Parquet out.

    ``checkpoint`` is the query's own folder in shared storage: a restart with
    the same one goes on where the query stopped. A sink belongs to one form: models within
    the lookup bound write to it as a stream, larger ones in runs.
    """
    stream = spark.readStream.schema(schema).parquet(source_path)
    return _start(stream, model_frame, sink_path, keys, checkpoint, text, trigger_once)


def start_scoring_text(spark: SparkSession, source_path: str, model_frame: DataFrame, sink_path: str,
                       checkpoint: str, trigger_once: bool = False) -> StreamingQuery:
    """Text files of sentences (one per line) in, (file, text, score, label) Parquet out."""
    lines = spark.readStream.text(source_path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    return _start(lines, model_frame, sink_path, ["file", "text"], checkpoint, "text", trigger_once)
