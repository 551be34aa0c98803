"""Source divergence audit by three-dimensional cube partitioning.

Every (lang, source) group and every lang gets a smoothed share of each kept
term, as an integer in thousand-millionths; two shares p and q of a term differ by
floor((p - q)^2 / q). The audit lists, per group, the divergence from each other
source of its lang, summed over all kept terms of the lang, and the terms that
it uses more than its lang does. All arithmetic is in whole numbers.

Terms. One pass counts occurrences and documents per (lang, source, term) within
each task, so that a frequent term or a source that holds a third of all rows
is one row per task before anything is shuffled. A lang's kept terms are those
in at least ``MIN_DOCS`` of its documents. They are dealt into term blocks of about
``TERMS`` by hash and numbered within their block.

Cube. The sources of a lang are dealt into group blocks of about ``SOURCES``. A
slice is one source's shares in one term block; it is replicated to every cell
(group block, group block, term block) that needs it. A cell holds two group
blocks of one term block, fills in the share of a term that a source lacks, and
computes the partial divergence of all its ordered pairs; sums over the term blocks give
the whole. A cell's size depends on the two block sizes only, whatever the
number of sources, terms or rows.

Defined cases: a NULL text, lang or source counts as ''; a group without kept
terms takes part with the shares of no occurrence; a lang without kept terms has
divergence 0 between its sources and no term rows; a lang with one source has no
pair rows; repeated rows and ids are documents of their own; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, arrow_schema, small

MIN_DOCS = 3  # documents of its lang that a kept term is in
TOP_TERMS = 200  # ranks listed per group
TERMS = 4096  # terms of a term block, about
SOURCES = 64  # sources of a group block, about
HELD = 400_000  # terms a task counts at one time

# A-Z lower-cased, other ASCII characters outside a-z to spaces, every other byte as it is.
_TERM_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 97 <= c <= 122 else 32 for c in range(256))


def term_counts(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    """(lang, source, term, n, docs) per task and share of it; a NULL term counts a group's documents."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang, source, text)]
    rows = docs.select(filled[0].alias("lang"), filled[1].alias("source"), filled[2].cast("binary").alias("t"))
    ddl = "lang string, source string, term string, n long, docs long"
    schema = arrow_schema(ddl)

    def table(held):
        for (of_lang, of_source), (n, found, rows_seen) in held.items():
            terms = [None, *n]
            yield pa.RecordBatch.from_arrays(
                [pa.array([of_lang] * len(terms), pa.string()), pa.array([of_source] * len(terms), pa.string()),
                 pa.array([t if t is None else t.decode() for t in terms], pa.string()),
                 pa.array([0, *n.values()], pa.int64()),
                 pa.array([rows_seen, *map(found.__getitem__, n)], pa.int64())], schema=schema)

    def run(batches):
        held, size = {}, 0
        for batch in batches:
            for of_lang, of_source, content in zip(*batch.columns, strict=True):
                key = of_lang.as_py(), of_source.as_py()
                if key not in held:
                    held[key] = [Counter(), Counter(), 0]
                    size += 1
                own = held[key]
                terms = content.as_py().translate(_TERM_TABLE).split()
                size -= len(own[0])
                own[0].update(terms)
                own[1].update(set(terms))
                own[2] += 1
                size += len(own[0])
                if size > HELD:
                    yield from table(held)
                    held, size = {}, 0
        yield from table(held)

    return (rows.mapInArrow(run, ddl).groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(1000000000 * (n + 1) / (total + terms)), exact for any count."""
    return F.call_function("div", F.lit(1_000_000_000) * (n + 1).cast("decimal(20,0)"),
                           (total + terms).cast("decimal(20,0)")) + 1


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares are at most 1000000001, so the square is a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def dictionary(kept: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, term, lang_n, block, place): kept terms with their block and number in it."""
    dealt = kept.join(small(langs.select("lang", "blocks")), "lang").select(
        "lang", "term", "lang_n", F.pmod(F.xxhash64("term"), "blocks").cast("int").alias("block"))
    # About TERMS rows to a window, dealt by hash.
    place = F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")) - 1
    return dealt.withColumn("place", place)


def cell(part: pd.DataFrame) -> pd.DataFrame:
    """Partial divergences of the ordered pairs of one cell of the cube."""
    shares = np.repeat(part["rest"].to_numpy(np.int64)[:, None], int(part["width"].iloc[0]), axis=1)
    for k, (places, values) in enumerate(zip(part["places"], part["shares"], strict=True)):
        shares[k, places] = values
    names, block = part["source"].to_numpy(object), part["own"].to_numpy()
    low, high = part["low"].iloc[0], part["high"].iloc[0]
    source, item, value = [], [], []
    for k in range(len(part)):
        others = np.flatnonzero(block == (high if block[k] == low else low))
        others = others[others != k]
        apart = shares[k] - shares[others]
        value.append((apart * apart // shares[others]).sum(axis=1))
        source.append(np.full(len(others), names[k], object))
        item.append(names[others])
    return pd.DataFrame({"lang": part["lang"].iloc[0], "source": np.concatenate(source),
                         "item": np.concatenate(item), "value": np.concatenate(value)})


def pair_divergences(held: DataFrame, groups: DataFrame, widths: DataFrame, sources: int) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of sources of a lang.

    ``held`` (lang, source, block, place, p), ``groups`` (lang, source, rest, blocks),
    ``widths`` (lang, block, width).
    """
    many = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / sources).cast("int").alias("sides"))
    every = groups.select("lang", "source", "rest", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    none = F.lit(None).cast("struct<place:int,p:bigint>")
    entry = F.struct(F.col("place").cast("int").alias("place"), F.col("p").cast("long").alias("p"))
    # One row per (source, term block), at most a block of terms in its lists.
    slices = (every.select("lang", "source", "block", "rest", none.alias("e"))
              .unionByName(held.select("lang", "source", "block", F.lit(None).cast("long").alias("rest"), entry.alias("e")))
              .groupBy("lang", "source", "block").agg(F.max("rest").alias("rest"), F.collect_list("e").alias("e")))
    slices = (slices.join(small(many), "lang").join(small(widths), ["lang", "block"], "left")
              .select("lang", "source", "block", "rest", "sides", F.coalesce("width", F.lit(0)).alias("width"),
                      F.transform("e", lambda x: x["place"]).alias("places"),
                      F.transform("e", lambda x: x["p"]).alias("shares"),
                      F.pmod(F.xxhash64("source"), "sides").cast("int").alias("own")))
    other = F.explode(F.sequence(F.lit(0), F.col("sides") - 1))
    cells = slices.withColumn("other", other).select(
        "lang", "source", "block", "rest", "width", "places", "shares", "own",
        F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    partial = cells.groupBy("lang", "low", "high", "block").applyInPandas(
        cell, "lang string, source string, item string, value long")
    return partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, terms: int = TERMS,
                      sources: int = SOURCES, lang: str = "lang", source: str = "source",
                      text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): parts ``pair`` and ``term`` of every group."""
    scratch = Scratch()
    counts = scratch.store(term_counts(docs, lang, source, text), "term_counts")
    kept = (counts.where("term IS NOT NULL").groupBy("lang", "term")
            .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= min_docs).drop("docs"))
    kept = scratch.store(kept, "kept_terms")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    langs = scratch.store(langs.withColumn("blocks", F.ceil(F.col("terms") / terms).cast("int")), "langs")
    numbered = scratch.store(dictionary(kept, langs), "term_blocks")
    held = counts.where("term IS NOT NULL").drop("docs").join(numbered, ["lang", "term"])
    held = scratch.store(held, "kept_counts")
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (counts.where("term IS NULL").select("lang", "source").join(totals, ["lang", "source"], "left")
              .join(small(langs), "lang", "left").fillna(0, ["total", "terms", "lang_total"]).fillna(1, ["blocks"]))
    # A lang without kept terms has no share to ask for: any will do, its width is 0.
    rest = F.when(F.col("terms") > 0, share(F.lit(0).cast("long"), F.col("total"), F.greatest("terms", F.lit(1))))
    groups = scratch.store(groups.withColumn("rest", F.coalesce(rest, F.lit(1).cast("long"))), "groups")
    scratch.release(counts, kept)

    shared = (held.join(small(groups.select("lang", "source", "total", "terms", "lang_total")), ["lang", "source"])
              .select("lang", "source", "term", "block", "place",
                      share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
                      share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q")))
    terms_part = shared.where("p > q").select("lang", "source", F.lit("term").alias("part"),
                                              F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    widths = scratch.store(numbered.groupBy("lang", "block").agg(F.count(F.lit(1)).alias("width")), "widths")
    pairs = pair_divergences(shared, groups, widths, sources).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    # The limit on the rank lets each task pass on its own first ranks only.
    return ranked(pairs).unionByName(ranked(terms_part).where(F.col("rank") <= top_terms))
