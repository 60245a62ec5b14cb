"""All registered queries: name to (Spark query, SQL or None)."""

from __future__ import annotations

from sievework.catalog import feature_queries, label_queries, metric_queries, record_queries

QUERIES = {
    **record_queries.QUERIES,
    **label_queries.QUERIES,
    **metric_queries.QUERIES,
    **feature_queries.QUERIES,
}
FLAGSHIP = feature_queries.top_terms
