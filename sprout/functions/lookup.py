"""Constant lookup tables for small, size-checked dictionaries.

A vocabulary or model has at most ``m`` rows, a bound the user sets. It is
shipped to tasks once, inside the plan, as a single folded literal: an array
of ``B`` small maps, bucketed by Spark's own ``xxhash64``. A probe hashes the
key, picks its bucket and looks it up there, so the cost per token does not
grow with ``m`` and featurization needs no shuffle. The bucket of each key is
computed by Spark on the vocabulary rows, so probe and build agree exactly.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS_PER_BUCKET = 2


@dataclass(frozen=True)
class HashedLookup:
    """String key -> INT value, probed with :meth:`get`."""

    buckets: int
    payload: str  # JSON array of B objects
    size: int

    def table(self) -> Column:
        return F.from_json(F.lit(self.payload), "array<map<string,int>>")

    def get(self, key: Column) -> Column:
        """Value for ``key``, NULL when absent."""
        if self.size == 0:
            return F.lit(None).cast("int")
        slot = (F.pmod(F.xxhash64(key), F.lit(self.buckets)) + F.lit(1)).cast("int")
        return F.try_element_at(F.try_element_at(self.table(), slot), key)


def build_lookup(rows: list[tuple[str, int, int]]) -> HashedLookup:
    """``rows`` are (key, value, xxhash64(key)) as computed by Spark."""
    size = len(rows)
    buckets = max(1, -(-size // KEYS_PER_BUCKET))
    table: list[dict[str, int]] = [{} for _ in range(buckets)]
    for key, value, digest in rows:
        table[digest % buckets][key] = int(value)
    return HashedLookup(buckets, json.dumps(table, separators=(",", ":")), size)


def collect_lookup(df: DataFrame, key: str, value: str) -> HashedLookup:
    """Collect a bounded (key, value) table into a :class:`HashedLookup`."""
    rows = df.select(F.col(key), F.col(value), F.xxhash64(F.col(key)).alias("_h")).collect()
    return build_lookup([(r[0], r[1], r[2]) for r in rows])


def weight_array(weights) -> Column:
    """ARRAY<DOUBLE> literal of the weights, exact (shortest round-trip text)."""
    values = [float(x) for x in weights]
    if not values:
        return F.array().cast("array<double>")
    return F.split(F.lit(",".join(repr(v) for v in values)), ",").cast("array<double>")
