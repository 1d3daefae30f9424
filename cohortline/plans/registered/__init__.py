"""Queries over the driver's tables, one per operator."""

from __future__ import annotations

from importlib import import_module

from .registry import ORACLES, QUERIES, Query

_PARTS = ("cohort", "images", "evaluation", "records", "text", "training")


def _load() -> None:
    for part in _PARTS:
        import_module(f"{__name__}.{part}")


def registered() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
