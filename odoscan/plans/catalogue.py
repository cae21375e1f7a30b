"""All registered queries. Importing the modules registers them."""

from odoscan.plans import cleaning_queries, feature_queries, folder_queries, model_queries, profile_queries, score_queries, series_queries
from odoscan.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "cleaning_queries", "feature_queries", "folder_queries", "model_queries", "profile_queries", "score_queries", "series_queries"]
