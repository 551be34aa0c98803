"""Tokenizer and sliding N-gram window as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The tokenizer contract. Text is lower-cased, then every run of
# ASCII letters with at most one inner apostrophe is a token.
TOKEN_PATTERN = r"[a-z]+(?:'[a-z]+)?"
# Case-preserving word pattern for the keyword corpus filter.
WORD_PATTERN = r"[A-Za-z]+(?:'[A-Za-z]+)?"


def tokenize(text: Column | str) -> Column:
    """ARRAY<STRING> of lower-cased tokens, in text order (NULL text: none)."""
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(TOKEN_PATTERN), 0)


def words(text: Column | str) -> Column:
    """ARRAY<STRING> of case-preserved words (keyword filter; NULL text: none)."""
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(WORD_PATTERN), 0)


def ngrams(tokens: Column | str, n: int) -> Column:
    """Contiguous N-token windows, step 1, joined by one space.

    A list shorter than ``n`` yields no N-grams. The window is built by
    zipping ``n`` shifted copies of the token list, which keeps the work
    linear in the row length. ``tokens`` should be a column reference (not
    the tokenizer expression itself) so the regex runs once per row.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    tok = F.col(tokens) if isinstance(tokens, str) else tokens
    if n == 1:
        return tok
    windows = F.transform(_shifted(tok, n), lambda z: _joined(z, n))
    return F.when(F.size(tok) >= n, windows).otherwise(F.array().cast("array<string>"))


def ngram_rows(rows: DataFrame, tokens: str, n: int) -> DataFrame:
    """(ngram): a row for every element of :func:`ngrams` of the column ``tokens``, joined once it is a row.

    The outer form keeps the optimizer from a filter on the size of the list,
    which would run the tokenizer a second time, before the rows are dealt out.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    exploded = rows.select(F.explode_outer(_shifted(F.col(tokens), n)).alias("_z")).where(F.col("_z").isNotNull())
    return exploded.select(_joined(F.col("_z"), n).alias("ngram"))


def _shifted(tok: Column, n: int) -> Column:
    count = F.greatest(F.size(tok) - F.lit(n - 1), F.lit(0))
    return F.arrays_zip(*[F.slice(tok, F.lit(k + 1), count).alias(str(k)) for k in range(n)])


def _joined(window: Column, n: int) -> Column:
    return F.concat_ws(" ", *[window.getField(str(k)) for k in range(n)])
