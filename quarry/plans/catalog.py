"""All registered queries. Importing a ``q_*`` module registers its queries."""

from __future__ import annotations

import importlib

from quarry.plans.registry import ORACLE, QUERIES

_MODULES = [
    "quarry.plans.q_drift",
    "quarry.plans.q_eval",
    "quarry.plans.q_profile",
    "quarry.plans.q_quality",
    "quarry.plans.q_prep",
    "quarry.plans.q_lead",
    "quarry.plans.q_misc",
    "quarry.plans.q_more",
    "quarry.plans.q_fit",
]


def load_all():
    for m in _MODULES:
        importlib.import_module(m)
    return QUERIES, ORACLE
