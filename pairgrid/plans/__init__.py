"""Derived tables and the registered queries over them."""

from importlib import import_module

_MODULES = (
    "ring_queries",
    "gate_queries",
    "planning_queries",
    "review_queries",
    "audit_queries",
    "release_queries",
    "pixel_queries",
    "source_queries",
)


def load() -> None:
    """Import every query module, which fills the registry."""
    for name in _MODULES:
        import_module(f"{__name__}.{name}")
