"""Loads every driver-query module and exposes the registry."""

from __future__ import annotations

import importlib

from quarry.plans import catalog

_MODULES = [
    "quarry.plans.q_retrieval",
    "quarry.plans.q_answer",
    "quarry.plans.q_text",
    "quarry.plans.q_scope",
    "quarry.plans.q_history",
    "quarry.plans.q_eval",
    "quarry.plans.q_sources",
    "quarry.plans.q_streaming",
    "quarry.plans.q_models",
    "quarry.plans.q_extra",
    "quarry.plans.q_index",
]


def _load():
    for m in _MODULES:
        importlib.import_module(m)


def all_queries():
    _load()
    return catalog.QUERIES


def all_oracles():
    _load()
    return catalog.ORACLES


def flagship(spark, sf_dir):
    _load()
    return catalog.QUERIES["answer_pipeline"](spark, sf_dir)
