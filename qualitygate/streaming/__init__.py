"""Structured Streaming jobs."""

from qualitygate.streaming.scoring import drop_repeats, score_stream

__all__ = ["drop_repeats", "score_stream"]
