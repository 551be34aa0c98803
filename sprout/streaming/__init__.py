"""Structured Streaming entry points."""

from .scoring import score_stream, start_scoring, start_scoring_text

__all__ = ["score_stream", "start_scoring", "start_scoring_text"]
