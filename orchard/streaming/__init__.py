"""Structured Streaming forms of operators that are plain aggregates.

The reference has no streams; the episode summary (M17) and the confusion
counts (E1) are ordinary aggregates, so they run unchanged on a stream of
logged steps.
"""

from orchard.streaming.episodes import stream_confusion, stream_episode_summary  # noqa: F401
