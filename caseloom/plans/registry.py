"""All registered queries and their oracles."""

from __future__ import annotations

from caseloom.plans import analysis_queries, learning_queries, text_queries, warehouse_queries

QUERIES: dict = {}
ORACLES: dict = {}
for _module in (warehouse_queries, analysis_queries, text_queries, learning_queries):
    QUERIES.update(_module.catalog.queries)
    ORACLES.update(_module.catalog.oracles)
