"""Registered queries over the given tables, each beside the SQL it must agree with."""

from importlib import import_module

MODULES = [
    "flights",
    "facts",
    "documents",
    "requests",
    "sessions",
    "evals",
    "storage",
    "streams",
    "warehouse",
]


def load_all() -> None:
    for name in MODULES:
        import_module(f"checks.{name}")
