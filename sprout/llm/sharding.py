"""Sharding by sampled splitters: shards of near-equal bytes.

Every record gets an order key: the upper 44 bits of its text's hash, then 20
bits of its id's hash. Equal texts are therefore neighbours, yet a hot text
still spreads over a million keys. A size-weighted sample of the keys gives
quantile boundaries, records are range-partitioned by them, and a range that
holds more than its share is subdivided with a sample of its own. Each range
is sorted by itself; the ranges' totals turn local positions into global byte
offsets, and the shards are cut from those offsets.

A cut that falls into a group of equal texts moves to the nearer edge of the
group when the group is small against a shard (``SNAP_SHARE``); a larger group
is cut at the record, so that the law ``bytes`` holds.

Defined cases: a NULL text has size 1 and crc32 0; NULL ids and repeated rows
are ordinary records; an empty table gives an empty result; extra columns are
ignored. A record belongs to the shard that holds the middle of its bytes.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, stored

SHARDS = 8
SAMPLES_PER_RANGE = 64  # sampled keys for each range
OVERFULL = 2.0  # a range above this multiple of its share is subdivided
SNAP_SHARE = 0.005  # groups below this share of a shard are not cut
GROUP_BITS = 20  # low bits of a key that differ within a group of equal texts


def _below(key: Column, splitters: np.ndarray) -> Column:
    """Range number: how many splitters are at or below the key."""
    @F.pandas_udf("int")
    def number(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splitters, keys.to_numpy(), side="right").astype(np.int32))
    return number(key)


def sample_keys(rows: DataFrame, total: int, wanted: int, draw: int = 0) -> np.ndarray:
    """About ``wanted`` keys, each drawn in proportion to its record's size.

    A record stands for size * wanted / total samples; the fraction left is
    decided by its own hash, so a repeated task draws the same keys. Large
    records count several times.
    """
    if not total:
        return np.array([], np.int64)
    expected = F.col("size") * F.lit(wanted / total)
    chance = F.pmod(F.xxhash64("_key", "_tie", F.lit(draw)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rows.select("_key", F.floor(expected + chance).cast("int").alias("n")).where("n > 0").toPandas()
    return np.sort(np.repeat(drawn["_key"].to_numpy(np.int64), drawn["n"].to_numpy(np.int64)))


def _quantiles(sample: np.ndarray, ranges: int) -> np.ndarray:
    if not len(sample) or ranges < 2:
        return np.array([], np.int64)
    return np.unique(sample[(np.arange(1, ranges) * len(sample)) // ranges])


def splitters_for(rows: DataFrame, total: int, ranges: int) -> np.ndarray:
    """Range boundaries; overfull ranges are sampled again and subdivided."""
    found = _quantiles(sample_keys(rows, total, ranges * SAMPLES_PER_RANGE), ranges)
    for draw in range(1, 9):  # each draw is finer than the one before
        sums = rows.groupBy(_below(F.col("_key"), found).alias("r")).agg(
            F.sum("size").alias("b"), F.min("_key").alias("lo"), F.max("_key").alias("hi"),
            F.max("size").alias("one")).toPandas()
        over = sums[(sums["b"] > OVERFULL * np.maximum(total / ranges, sums["one"])) & (sums["lo"] < sums["hi"])]
        more = []
        for r in over.itertuples():
            parts = math.ceil(r.b * ranges / total)
            inside = rows.where((F.col("_key") >= int(r.lo)) & (F.col("_key") <= int(r.hi)))
            more.append(_quantiles(sample_keys(inside, int(r.b), parts * SAMPLES_PER_RANGE * 2 ** draw, draw),
                                   parts))
        if not more:
            break
        found = np.unique(np.concatenate([found, *more]))
    return found


def shard(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per document."""
    raw = F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.when(F.col(text).isNull(), F.lit(1)).otherwise(F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.xxhash64(raw).alias("_hash"), F.monotonically_increasing_id().alias("_tie"))
    mask = (1 << GROUP_BITS) - 1
    rows = stored(rows.withColumn(
        "_key", F.col("_hash").bitwiseAND(F.lit(~mask)).bitwiseOR(
            F.xxhash64("doc_id", "_tie").bitwiseAND(F.lit(mask)))).drop("_hash"), "shard_records")
    total = int(rows.agg(F.sum("size")).first()[0] or 0)
    ranges = max(4 * shards, partitions(docs.sparkSession))
    found = splitters_for(rows, total, ranges)

    placed = rows.withColumn("_range", _below(F.col("_key"), found))
    inside = Window.partitionBy("_range").orderBy("_key", "doc_id", "_tie").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = stored(placed.select("doc_id", "size", "text_crc32", "_key", "_range",
                                 (F.sum("size").over(inside) - F.col("size")).alias("_at"),
                                 (F.row_number().over(Window.partitionBy("_range").orderBy("_key", "doc_id", "_tie"))
                                  - 1).cast("long").alias("_row")), "shard_ranges")
    # One row per range: their running totals are the ranges' global offsets.
    sums = local.groupBy("_range").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).toPandas()
    sums = sums.sort_values("_range")
    offsets = local.sparkSession.createDataFrame(
        [(int(r), int(b), int(n)) for r, b, n in zip(sums["_range"], sums["b"].cumsum() - sums["b"],
                                                    sums["n"].cumsum() - sums["n"], strict=True)],
        "_range int, _bytes long, _rows long")
    rows = local.join(F.broadcast(offsets), "_range").select(
        "doc_id", "size", "text_crc32", "_key", (F.col("_at") + F.col("_bytes")).alias("_at"),
        (F.col("_row") + F.col("_rows")).alias("_row"))

    middle = F.col("_at") + F.col("size") / 2
    number = F.lit(0)
    for cut in cuts(rows, total, shards):
        number = number + (middle >= F.lit(cut)).cast("int")
    numbered = rows.withColumn("shard", number)
    starts = numbered.groupBy("shard").agg(F.min("_row").alias("_start"))  # one row per shard
    return numbered.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_row") - F.col("_start")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def cuts(rows: DataFrame, total: int, shards: int) -> list[float]:
    """Byte offsets of the shard cuts, off small groups of equal texts."""
    ideal = [total * s / shards for s in range(1, shards)]
    if not total:
        return ideal
    group = F.shiftright("_key", GROUP_BITS)
    met = F.lit(False)
    for at in ideal:
        met = met | ((F.col("_at") < F.lit(at)) & (F.col("_at") + F.col("size") > F.lit(at)))
    hit = [r[0] for r in rows.where(met).select(group.alias("g")).distinct().collect()]  # at most shards - 1
    edges = rows.where(group.isin(hit)).groupBy(group.alias("g")).agg(
        F.min("_at").alias("lo"), F.max(F.col("_at") + F.col("size")).alias("hi")).collect()
    out = []
    for at in ideal:
        for e in edges:
            if e["lo"] < at < e["hi"] and e["hi"] - e["lo"] <= SNAP_SHARE * total / shards:
                at = e["lo"] if at - e["lo"] <= e["hi"] - at else e["hi"]
        out.append(float(at))
    return out
