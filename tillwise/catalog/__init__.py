"""Registered queries: ``REGISTRY[key]`` holds the Spark builder and oracle SQL.

Importing this package imports every catalog module so all keys register.
"""

from tillwise.catalog.base import REGISTRY, Entry, finish, oracle_text  # noqa: F401
from tillwise.catalog import (core, extra, governance, insight, inventory, learning, metrics, modeling, neighbours,  # noqa: F401
                              people, pricing, product, text, timeseries)


def spark_queries():
    return {k: e.build for k, e in REGISTRY.items()}


def oracle_queries():
    return {k: oracle_text(e) for k, e in REGISTRY.items() if e.sql is not None}
