"""Every operator as a query over the provided tables, with its SQL equivalent where there is one."""

import importlib

MODULES = ("texts", "tables", "splitting", "pairing", "encoding", "programs", "vectors", "vocabularies")


def load_all() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        importlib.import_module(f"codelake.catalog.{name}")
