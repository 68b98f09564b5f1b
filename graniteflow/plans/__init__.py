"""Named queries over the input tables."""

from importlib import import_module

from graniteflow.plans.catalog import QUERIES, SQL

_MODULES = [
    "text_queries", "column_queries", "table_queries", "metric_queries", "recommend_queries",
    "regress_queries", "cluster_queries", "model_queries", "stream_queries",
]


def _load() -> None:
    for name in _MODULES:
        import_module(f"graniteflow.plans.{name}")


def all_queries():
    _load()
    return dict(QUERIES)


def all_sql():
    _load()
    return dict(SQL)
