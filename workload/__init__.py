"""Queries over the given tables, one per operator, with their expected SQL."""

from workload import check_queries, column_queries, config_queries, result_queries, store_queries

QUERY_MODULES = (store_queries, config_queries, column_queries, check_queries, result_queries)
