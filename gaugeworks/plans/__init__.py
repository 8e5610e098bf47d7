"""Registered queries over the driver tables, each with its check in plain SQL where one exists."""

from __future__ import annotations

import importlib

_MODULES = ("analytics", "entities", "operations", "streams")


def load_all():
    """Import every module with registrations and return the registry."""
    for name in _MODULES:
        importlib.import_module(f"gaugeworks.plans.{name}")
    return importlib.import_module("gaugeworks.plans.registry").REGISTRY
