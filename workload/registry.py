"""All registered queries."""

from __future__ import annotations

from workload import answer_queries, html_queries, store_queries, url_queries

MODULES = (url_queries, html_queries, answer_queries, store_queries)
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in MODULES for k, v in m.ORACLES.items()}
flagship = html_queries.annotations_per_host
