"""Structured Streaming entry points.

The reference has no stream operators; the only streaming use here is the
batch scoring job (I8 + A5) applied to files as they arrive.
"""

from hearth.streaming.scoring import score_stream

__all__ = ["score_stream"]
