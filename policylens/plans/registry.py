"""Collects every query module so the catalog is complete on import."""

from __future__ import annotations

from policylens.plans import catalog
from policylens.plans import (q_features, q_monitor, q_policy, q_quote, q_registry, q_requests,  # noqa: F401
                              q_ml, q_sinks, q_streaming)


def queries():
    return dict(catalog.QUERIES)


def oracle_sql():
    return {k: v for k, v in catalog.ORACLES.items() if k in catalog.QUERIES}
