"""Registered queries over the driver's tables, each with its check SQL where SQL can say it."""

from importlib import import_module

MODULES = (
    "post_queries", "text_queries", "expression_queries", "operations_queries", "ingest_queries", "stream_queries",
)


def load() -> None:
    """Import every query module, which fills the catalogue."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")
