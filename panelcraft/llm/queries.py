"""Registered queries of this package and their SQL."""

from panelcraft.llm import base_queries, model_queries

QUERIES = {**base_queries.QUERIES, **model_queries.QUERIES}
ORACLES = {**base_queries.ORACLES, **model_queries.ORACLES}
