"""All registered queries by name."""

from seqloom.plans import corpus_queries, curation_queries, metric_queries, vector_queries, web_queries

_MODULES = (corpus_queries, metric_queries, vector_queries, curation_queries, web_queries)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
