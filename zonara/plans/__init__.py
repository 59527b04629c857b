"""The queries and their SQL."""

from zonara.plans.queries import QUERIES
from zonara.plans.sql import SQL

__all__ = ["QUERIES", "SQL"]
