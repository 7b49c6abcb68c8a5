"""Registered queries over the driver tables, each with its oracle SQL if one exists."""

from __future__ import annotations

from . import controls, distribution, evaluation, experiments, features, labels, models, payloads, storage
from .registry import QUERIES, ORACLES

__all__ = ["QUERIES", "ORACLES"]

_MODULES = (distribution, controls, labels, evaluation, features, experiments, payloads, storage, models)
