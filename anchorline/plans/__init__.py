"""The query catalogue."""

from anchorline.plans import answer_queries, assign_queries, frame_queries, fuse_queries, join_queries, motion_queries, proposal_queries, source_queries, table_queries, window_queries
from anchorline.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "join_queries", "proposal_queries", "table_queries", "window_queries"]
