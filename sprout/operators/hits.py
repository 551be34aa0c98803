"""Join of rows' N-grams with a table keyed by N-gram, for tables too large to ship as a constant.

Each row is told apart by a number of its own and first combined: one entry per distinct
N-gram, with its places. N-grams that a sketch finds in many entries are looked up in the
rows themselves (their part of the table is small and bounded by the sketch), so no
join key holds a large share of the entries; the rest is shuffled to the table. A row
sends one more entry under a key that no N-gram equals; it carries the caller's columns and the
hits made in the row, so rows without a hit are kept. Hits come back in text order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lookup import build_lookup

HEAVY = 1_000  # N-grams looked up in the rows, at most
TRACKED = 10_000  # N-grams that the sketch follows at one time
HEAVY_SHARE = 1e-4  # of all entries: an N-gram in more of them is heavy


def combined(rows: DataFrame, ng: str = "ng") -> DataFrame:
    """``rows`` with ``ng`` replaced by ``e`` ARRAY<STRUCT<ngram, at ARRAY<INT>>>: distinct N-grams and their places.

    One sort per row; each step is a column of its own, so nothing is evaluated per element.
    """
    other = [c for c in rows.columns if c != ng]
    places = F.transform(ng, lambda g, k: F.struct(g.alias("g"), k.cast("int").alias("k")))
    tagged = rows.select(*other, F.array_sort(places).alias("_t"))
    # First places of the runs of equal N-grams, and the end.
    first = F.filter(F.sequence(F.lit(0), F.size("_t") - 1), lambda i: (i == 0) | (
        F.get("_t", i)["g"] != F.get("_t", i - 1)["g"]))
    cuts = F.when(F.size("_t") > 0, F.concat(first, F.array(F.size("_t")))).otherwise(F.array().cast("array<int>"))
    cut = tagged.select(*other, "_t", cuts.alias("_c"))
    run = F.transform(F.slice("_c", 1, F.greatest(F.size("_c") - 1, F.lit(0))), lambda a, k: F.struct(
        F.get("_t", a)["g"].alias("ngram"),
        F.transform(F.slice("_t", a + 1, F.get("_c", k + 1) - a), lambda t: t["k"]).alias("at")))
    return cut.select(*other, run.alias("e"))


def heavy_ngrams(entries: DataFrame) -> list[str]:
    """N-grams in more than HEAVY_SHARE of the entries (ngram), at most HEAVY, by a mergeable sketch."""
    row = entries.agg(F.count("ngram").alias("n"), F.expr(f"approx_top_k(ngram, {HEAVY}, {TRACKED})").alias("top")).first()
    return [x["item"] for x in row["top"] or [] if x["item"] is not None and x["count"] > HEAVY_SHARE * row["n"]]


def ngram_hits(rows: DataFrame, table: DataFrame, keep) -> DataFrame:
    """(keep..., hits ARRAY<STRUCT<k, value>>): one row per row of ``rows`` (keep..., ng), hits in text order.

    ``table`` is (ngram, value), N-grams unique, values not NULL.
    """
    keep = list(keep)
    kind = table.schema["value"].dataType.simpleString()
    row = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.lit(0).alias("_"))
    numbered = rows.select(F.monotonically_increasing_id().alias("_row"), row.alias("_keys"),
                           F.coalesce("ng", F.array().cast("array<string>")).alias("ng"))
    heavy = heavy_ngrams(numbered.select(F.explode(F.array_distinct("ng")).alias("ngram")))
    known = {r["ngram"]: r["value"] for r in table.where(F.col("ngram").isin(heavy)).collect()} if heavy else {}
    digests = {r[0]: r[1] for r in _digests(rows, heavy)}
    # Place in ``values`` of every heavy N-gram; one that the table lacks has the place of NULL.
    values = [known.get(g) for g in heavy]
    lookup = build_lookup([(g, k, digests[g]) for k, g in enumerate(heavy)])
    held = F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")
    numbered = combined(numbered)
    placed = F.transform("e", lambda x: F.struct(x["ngram"].alias("ngram"), x["at"].alias("at"),
                                                 lookup.get(x["ngram"]).alias("heavy")))
    numbered = numbered.select("_row", "_keys", placed.alias("e"))
    own = F.filter(F.transform(F.filter("e", lambda x: x["heavy"].isNotNull()), lambda x: F.struct(
        x["at"].alias("at"), F.get(held, x["heavy"]).alias("value"))), lambda x: x["value"].isNotNull())
    none = F.lit(None).cast("array<int>")
    marker = F.struct(F.concat(F.lit("\x00"), F.col("_row").cast("string")).alias("ngram"), none.alias("at"))
    rest = F.transform(F.filter("e", lambda x: x["heavy"].isNull()),
                       lambda x: F.struct(x["ngram"].alias("ngram"), x["at"].alias("at")))
    entries = (numbered.select("_row", "_keys", own.alias("_own"), F.explode(F.concat(F.array(marker), rest)).alias("x"))
               .select("_row", F.col("x.ngram").alias("ngram"), F.col("x.at").alias("at"),
                       *[F.when(F.col("x.at").isNull(), F.col(c)).alias(c) for c in ("_keys", "_own")]))
    joined = (entries.join(table, "ngram", "left").where(F.col("value").isNotNull() | F.col("at").isNull())
              .groupBy("_row").agg(
                  F.first("_keys", ignorenulls=True).alias("_keys"), F.first("_own", ignorenulls=True).alias("_own"),
                  F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "value"))).alias("_found")))
    spread = F.flatten(F.transform(F.concat("_own", "_found"), lambda h: F.transform(
        h["at"], lambda k: F.struct(k.alias("k"), h["value"].alias("value")))))
    return joined.select(*[F.col(f"_keys.k{i}").alias(c) for i, c in enumerate(keep)], F.array_sort(spread).alias("hits"))


def _digests(rows: DataFrame, ngrams: list[str]) -> list:
    """(ngram, xxhash64(ngram)) as Spark computes it, at most HEAVY rows."""
    if not ngrams:
        return []
    spark = rows.sparkSession
    return spark.createDataFrame([(g,) for g in ngrams], "g string").select("g", F.xxhash64("g")).collect()
