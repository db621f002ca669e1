"""Registered queries: every operator over the given tables."""

from __future__ import annotations


def _load():
    from cartoweave.catalog import registry
    from cartoweave.catalog import aggregates, crowded, filtering, joins, scalars, scanning  # noqa: F401

    return registry


def all_queries():
    return dict(_load().QUERIES)


def all_oracles():
    return dict(_load().ORACLES)
