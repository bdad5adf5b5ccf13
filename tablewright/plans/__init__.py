"""Registered queries: each pairs an operator call with the SQL it must agree with."""

from importlib import import_module

SECTIONS: tuple[str, ...] = (
    "columns",
    "quality",
    "io",
    "aggregates",
    "order",
    "evaluation",
    "recommend",
    "domains",
    "models",
)


def load_sections() -> None:
    for name in SECTIONS:
        import_module(f"tablewright.plans.{name}")
