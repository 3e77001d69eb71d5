"""Named queries: every operator of the survey engine bound to the driver tables."""

from __future__ import annotations

import importlib

from .registry import ORACLES, QUERIES

_MODULES = ["records", "streams", "reshaping", "aggregates", "cleaning", "interviews", "datasets", "incremental", "periods"]


def all_queries():
    for m in _MODULES:
        importlib.import_module(f"{__name__}.{m}")
    return QUERIES, ORACLES
