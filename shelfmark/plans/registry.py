"""All queries of the library and the SQL that each is checked against."""

from __future__ import annotations

from shelfmark.plans import feeds, jobs, stores  # noqa: F401  they register their queries too
from shelfmark.plans.catalog import QUERIES, SQL

FLAGSHIP = "daily_memory"

__all__ = ["FLAGSHIP", "QUERIES", "SQL"]
