"""Segment-hour feature engine: feature tables keyed by (track segment, hour) as Spark plans."""

from segment_hours.session import build_session

__all__ = ["build_session"]
