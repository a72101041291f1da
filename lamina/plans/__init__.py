"""The query set: one entry per operator of the survey."""

from __future__ import annotations


def _load() -> None:
    import importlib

    for name in ("relational", "layers", "geometry", "spatial"):
        importlib.import_module(f"lamina.plans.{name}")


def all_queries() -> dict:
    from lamina.plans.catalog import QUERIES

    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    from lamina.plans.catalog import ORACLES

    _load()
    return dict(ORACLES)
