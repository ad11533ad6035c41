"""Importing the query modules fills the registry."""

from panel_queries import core, derive, modeling, scoring, study  # noqa: F401
from panel_queries.base import ORACLES, QUERIES  # noqa: F401
