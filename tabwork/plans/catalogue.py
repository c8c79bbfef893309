"""All registered queries and their SQL checks."""

from __future__ import annotations

from tabwork.plans import (
    cluster_queries, missing_queries, plot_queries, prepare_queries, profile_queries, relational_queries, stats_queries,
)

_MODULES = (relational_queries, profile_queries, missing_queries, stats_queries, prepare_queries, cluster_queries, plot_queries)

QUERIES = {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}
ORACLE = {name: text for module in _MODULES for name, text in module.ORACLE.items()}
