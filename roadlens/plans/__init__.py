"""Named queries: Spark builders plus oracle SQL for the correctness gate."""

from roadlens.plans.registry import REGISTRY, Query, register  # noqa: F401

MODULES = ("dashboard_queries", "quality_queries", "etl_queries", "nested_queries",
           "stream_queries", "model_queries", "fuzzy_queries", "io_queries")


def load_all():
    """Import every query module so that it registers its queries."""
    import importlib
    for mod in MODULES:
        importlib.import_module(f"roadlens.plans.{mod}")
    return REGISTRY
