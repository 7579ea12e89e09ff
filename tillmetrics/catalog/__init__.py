"""Queries over the benchmark tables, each with the SQL it is checked against."""

from importlib import import_module
from importlib.util import find_spec

MODULES = ["profit", "conversion", "sales", "files", "keyed", "documents", "quality", "unified", "stream", "scale", "stored"]


def load_all() -> None:
    for name in MODULES:
        module = f"{__name__}.{name}"
        if find_spec(module):
            import_module(module)
