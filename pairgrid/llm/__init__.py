"""Operators for training-data pipelines, and their registered queries."""

from importlib import import_module

_MODULES = (
    "quality",
    "warc",
    "token_counts",
    "simhash",
    "language",
    "neighbours",
    "mixing",
    "packing",
    "chat",
    "fingerprints",
    "alignment",
    "prefix_trie",
    "personal_data",
)


def load() -> None:
    """Import every module, which fills the registry of this subpackage."""
    for name in _MODULES:
        import_module(f"{__name__}.{name}")
