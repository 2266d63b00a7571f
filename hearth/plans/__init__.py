"""Registered queries over the driver tables and the end-to-end jobs."""

from hearth.plans.registry import QUERIES, ORACLES, SURVEY_IDS
from hearth.plans import (cleaning_queries, feature_queries, sampling_queries,  # noqa: F401
                          profile_queries, stats_queries, model_queries, source_queries,
                          closed_form_queries, search_queries, exact_tree_queries, logistic_queries)

__all__ = ["QUERIES", "ORACLES", "SURVEY_IDS"]
