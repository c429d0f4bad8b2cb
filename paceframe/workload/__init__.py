"""Registered queries over the test tables, grouped by operator family."""

from .registry import ORACLES, QUERIES, Query


def _load() -> None:
    from . import features, flows, quality, relational, segments  # noqa: F401


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
