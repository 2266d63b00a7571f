"""hearth: Spark-native tabular regression analytics.

Every public operator takes a DataFrame and returns a DataFrame (or a
small, bounded result plus a DataFrame). Work runs on Spark: global
statistics are single-pass aggregates, ranks are range-partitioned,
models are Spark ML estimators.
"""

from hearth.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
