"""Scalar statistics: information gain, logistic, threshold and sign rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _xlog2(x: Column, y: Column) -> Column:
    """x * log2(y), evaluated as (x * log10(y)) / log10(2) like the reference."""
    return x * F.log10(y) / F.log10(F.lit(2.0))


def information_gain(p1: Column, n1: Column, positives, negatives) -> Column:
    """Split score of one N-gram, NULL where it is undefined.

    ``p1``/``n1`` count positive/negative sentences that contain the N-gram,
    ``positives``/``negatives`` all labelled sentences of each class. The
    formula is the reference's: the second term is weighted by the first
    branch's class probability. It is finite only when both branches hold
    both classes; every other N-gram gets NULL and ranks last.
    """
    pos = F.lit(positives).cast("double") if not isinstance(positives, Column) else positives.cast("double")
    neg = F.lit(negatives).cast("double") if not isinstance(negatives, Column) else negatives.cast("double")
    p1 = p1.cast("double")
    n1 = n1.cast("double")
    p2 = pos - p1
    n2 = neg - n1
    w1 = (p1 + n1) / (pos + neg)
    w2 = F.lit(1.0) - w1
    a = p1 / (p1 + n1)
    b = p2 / (p2 + n2)
    left = _xlog2(a, a) + _xlog2(F.lit(1.0) - a, F.lit(1.0) - a)
    right = _xlog2(a, b) + _xlog2(F.lit(1.0) - b, F.lit(1.0) - b)
    defined = (p1 > 0) & (n1 > 0) & (p2 > 0) & (n2 > 0)
    return F.when(defined, w1 * left + w2 * right)


def sigmoid(score: Column) -> Column:
    """1 / (1 + e^-s). exp overflow gives Infinity, hence 0, never an error."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def binary_target(label: Column) -> Column:
    """Label 1 -> 1.0, anything else -> 0.0."""
    return F.when(label > 0, F.lit(1.0)).otherwise(F.lit(0.0))


def threshold_cut(score: Column, threshold: float) -> Column:
    """score > t -> 1, score < -t -> -1, else 0 (both bounds strict)."""
    return (F.when(score > F.lit(float(threshold)), F.lit(1))
            .when(score < F.lit(-float(threshold)), F.lit(-1))
            .otherwise(F.lit(0)))


def threshold_decision(score: Column, threshold: float) -> Column:
    """Like :func:`threshold_cut` but NULL (no decision) instead of 0."""
    return (F.when(score > F.lit(float(threshold)), F.lit(1))
            .when(score < F.lit(-float(threshold)), F.lit(-1)))


def sign_marker(score: Column) -> Column:
    """Single-sentence decision: '+' when score > 0, else '-' (0 is '-')."""
    return F.when(score > 0, F.lit("+")).otherwise(F.lit("-"))
