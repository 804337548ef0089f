"""Collects the query modules so their ``@register`` entries exist."""

from __future__ import annotations

from . import catalog


def _load() -> None:
    # importing the modules registers their queries
    from . import q_experiment, q_external, q_mix, q_quality, q_staging, q_trends  # noqa: F401


def queries():
    _load()
    return dict(catalog.QUERIES)


def oracle_sql():
    _load()
    return dict(catalog.ORACLE)
