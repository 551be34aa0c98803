"""Benchmark decontamination with a distributed positional inverted index.

Test items become windows of ``WINDOW`` consecutive words (a shorter item is
one window). One pass over the corpus measures the posting list of every test
term (the number of documents that hold it); a window with a term that the
corpus lacks is dropped. Each window is then represented by its two rarest
terms, at their places in the item. A second pass stores the positional
postings of these terms. Lists are offset-adjusted: a posting minus the term's
place in the item is the diagonal on which the item would stand in the
document. Where the diagonal of a window's two terms is the same, the window
is a phrase candidate; where they are at most ``slop`` apart, whatever else
stands between them, it is a proximity match. The remaining terms of a candidate are compared with the
document's words, so that phrase matches are exact.

All steps are DataFrame operations. Test items are a stated query set: they
are worked on in blocks with at most about ``BLOCK_TERMS`` distinct words and
``BLOCK_WORDS`` words, so what a task is sent stays small for any number of items.

Defined cases: a NULL text, document or item, has no words; an item without
words has no window, one without an id is left out; repeated documents are
judged alike, also under one id; item ids count once; empty tables give empty
or clean results; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small, stored, text_or_empty, words

WINDOW = 10
SLOP = 2
BLOCK_TERMS, BLOCK_WORDS = 50_000, 1_000_000

#: What names a document's text: its id and a hash of the text (NULL ids share one value).
KEY = ["_id", "_text_hash"]


def _id(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("\x00"))


def document_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry=()) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), *carry, _id(doc_id).alias("_id"),
                       F.xxhash64(text_or_empty(text)).alias("_text_hash"),
                       words(text_or_empty(text)).alias("_words"))


def item_words(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, _seq, item): each item's words; items with equal words share ``_seq``."""
    own = items.select(F.col(item_id).cast("string").alias("item_id"), words(text_or_empty(text)).alias("item"))
    own = own.where(F.col("item_id").isNotNull() & (F.size("item") > 0))
    return own.withColumn("_seq", F.xxhash64(F.array_join("item", " "))).dropDuplicates(["item_id", "_seq"])


def collected_terms(df: DataFrame) -> list[str]:
    """Distinct terms of one block of items, bounded by the block."""
    return [r[0] for r in df.select("term").distinct().collect()]


def list_lengths(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(term, n): documents in the posting list of every term that occurs."""
    own = F.array_distinct(F.filter("_words", lambda w: w.isin(terms)))
    return docs.select(F.explode(own).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def item_windows(seqs: DataFrame, lengths: DataFrame, width: int) -> DataFrame:
    """(_seq, s, len, p1, p2): windows and the places of their two rarest terms in the item.

    Windows with a term without postings can't occur and are left out.
    """
    terms = seqs.select("_seq", F.posexplode("item").alias("at", "term")).join(lengths, "term", "left")
    # One row per item: its places in order, as long as the item.
    items = terms.groupBy("_seq").agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("t"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("t") - width, F.lit(0)))
    cut = items.select("_seq", "t", F.explode(starts).alias("s")).withColumn(
        "t", F.slice("t", F.col("s") + 1, F.lit(width)))
    ranked = F.sort_array(F.transform("t", lambda x: F.struct(x["n"].alias("n"), x["at"].alias("at"))))
    return (cut.where(~F.exists("t", lambda x: x["n"].isNull()))
            .select("_seq", "s", F.size("t").alias("len"), ranked.alias("r"))
            .select("_seq", "s", "len", F.get("r", F.lit(0))["at"].alias("p1"), F.get("r", F.lit(1))["at"].alias("p2")))


def postings(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(_id, _text_hash, term, pos): positional postings of ``terms``."""
    places = F.filter(F.sequence(F.lit(0), F.size("_words") - 1), lambda k: F.get("_words", k).isin(terms))
    held = F.transform(places, lambda k: F.struct(k.alias("pos"), F.get("_words", k).alias("term")))
    return (docs.where(F.size("_words") > 0).select(*KEY, F.explode(held).alias("p"))
            .select(*KEY, "p.term", "p.pos"))


def intersected(index: DataFrame, anchors: DataFrame, wins: DataFrame, slop: int) -> DataFrame:
    """(KEY, _seq, s, len, start, meets): windows whose two lists meet on a diagonal, or nearly.

    ``anchors`` (_seq, at, term) are the places of the windows' rarest terms.
    """
    diagonals = (index.join(F.broadcast(anchors), "term")
                 .select(*KEY, "_seq", (F.col("pos") - F.col("at")).alias("diag"), "at")
                 .repartition(*KEY, "_seq")
                 .groupBy(*KEY, "_seq", "diag").agg(F.collect_set("at").alias("own")))
    order = Window.partitionBy(*KEY, "_seq").orderBy("diag")
    # The places on all diagonals within slop, at most slop rows.
    beside = F.flatten(F.collect_list("own").over(order.rangeBetween(1, slop))) if slop > 0 else F.array().cast("array<int>")
    diagonals = diagonals.withColumn("beside", beside)
    single = F.broadcast(wins.where("p2 IS NULL").select("_seq").distinct().withColumn("single", F.lit(True)))
    diagonals = (diagonals.join(single, "_seq", "left")
                 .where((F.size("own") > 1) | (F.size("beside") > 0) | F.col("single")))
    on = lambda places, p: F.coalesce(F.array_contains(places, F.col(p)), F.lit(False))
    meets = on("own", "p1") & (F.col("p2").isNull() | on("own", "p2"))
    nears = (on("own", "p1") & on("beside", "p2")) | (on("own", "p2") & on("beside", "p1"))
    return (diagonals.join(F.broadcast(wins), "_seq").where("diag + s >= 0")
            .withColumn("meets", meets).where(F.col("meets") | nears)
            .select(*KEY, "_seq", "s", "len", (F.col("diag") + F.col("s")).alias("start"), "meets"))


def block_matches(docs: DataFrame, seqs: DataFrame, width: int, slop: int) -> DataFrame:
    """(KEY, _seq, start, len, exact) of one block of items."""
    places = seqs.select("_seq", F.posexplode("item").alias("at", "term"))
    lengths = stored(list_lengths(docs, collected_terms(places)), "list_lengths")
    wins = stored(item_windows(seqs, lengths, width), "item_windows")
    rarest = wins.select("_seq", F.explode(F.array_compact(F.array("p1", "p2"))).alias("at")).distinct()
    anchors = stored(places.join(rarest, ["_seq", "at"]), "anchors")
    index = stored(postings(docs, collected_terms(anchors)), "postings")
    found = stored(intersected(index, anchors, wins, slop), "candidates")

    # The other terms: only documents with a candidate are read again.
    phrases = found.where("meets").distinct()
    where = small(phrases.select(*KEY).distinct())
    texts = docs.select(*KEY, "_words").join(where, KEY, "left_semi").dropDuplicates(KEY)
    exact = (texts.join(phrases, KEY).join(F.broadcast(seqs), "_seq")
             .where(F.slice("_words", F.col("start") + 1, F.col("len")) == F.slice("item", F.col("s") + 1, F.col("len")))
             .select(*KEY, "_seq", "start", "len", F.lit(True).alias("exact")))
    near = found.where("NOT meets").select(*KEY, "_seq", "start", "len", F.lit(False).alias("exact"))
    return exact.unionByName(near).distinct()


def matches(docs: DataFrame, items: DataFrame, width: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """Phrase and proximity matches of all items, block by block."""
    seqs = items.select("_seq", "item").dropDuplicates(["_seq"])
    size = seqs.select(F.explode("item").alias("term")).agg(
        F.countDistinct("term").alias("terms"), F.count(F.lit(1)).alias("words")).first()
    blocks = max(1, -(-size["terms"] // BLOCK_TERMS), -(-size["words"] // BLOCK_WORDS))
    parts = [stored(block_matches(docs, seqs.where(F.pmod("_seq", F.lit(blocks)) == b), width, slop), "matches")
             for b in range(blocks)]
    return reduce(DataFrame.unionByName, parts)


def decontaminate(docs: DataFrame, items: DataFrame, width: int = WINDOW, slop: int = SLOP,
                  doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", carry=()) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near, carry...), one row per document."""
    tokens = document_words(docs, doc_id, text, carry)
    named_items = stored(item_words(items, item_id, item_text), "items")
    found = matches(tokens, named_items, width, slop)
    exact = found.where("exact")

    # Words inside any window: the union of intervals, by a running end.
    spans = exact.groupBy(*KEY, "start").agg((F.max("start") + F.max("len")).alias("end"))
    before = Window.partitionBy(*KEY).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))), F.lit(0))
    hits = spans.select(*KEY, fresh.alias("n")).groupBy(*KEY).agg(F.sum("n").cast("long").alias("n_hit"))
    named = (exact.select(*KEY, "_seq").distinct().join(named_items.select("_seq", "item_id"), "_seq")
             .groupBy(*KEY).agg(F.sort_array(F.collect_set("item_id")).alias("ids")))
    near = found.where("NOT exact").groupBy(*KEY).agg(F.countDistinct("_seq", "start").alias("n_near"))
    # Words are counted once; the join below reads these few columns, however often it is planned anew.
    lengths = stored(tokens.select("doc_id", *carry, *KEY, F.size("_words").cast("long").alias("n_words")), "lengths")
    return (lengths
            .join(hits.join(named, KEY).join(near, KEY, "full"), KEY, "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
                    F.coalesce("n_near", F.lit(0)).alias("n_near"), *carry))
