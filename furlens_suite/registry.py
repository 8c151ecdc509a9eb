"""All registered queries: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from furlens_suite import acquire_queries, clean_queries, feature_queries, learn_queries, source_queries

REGISTERED = {
    **source_queries.QUERIES,
    **clean_queries.QUERIES,
    **acquire_queries.QUERIES,
    **feature_queries.QUERIES,
    **learn_queries.QUERIES,
}
