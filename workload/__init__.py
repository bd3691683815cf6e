"""The registered queries: each operator bound to the given tables, with its SQL twin."""

from __future__ import annotations

from workload import cleaning, jobs, metrics, profiling, relations, streams, tables

MODULES = (jobs, tables, profiling, cleaning, metrics, relations, streams)


def all_queries():
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_oracles():
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
