"""All queries over the driver tables, by name, with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from strandwise.plans import cohort, relational, reports, statistics, variants  # noqa: F401  they register themselves
from strandwise.plans.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
