"""All queries of the catalogue: QUERIES by name, ORACLE with the same in SQL."""

from __future__ import annotations

from ferrule.plans import browsing, changes, curation, merging, publishing, rankings, records, resolution, reviewing, scanning, statistics, text  # noqa: F401  they register their queries
from ferrule.plans.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
