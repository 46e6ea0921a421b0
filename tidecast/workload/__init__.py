"""Named queries over the given tables, each with an independent SQL counterpart."""

from __future__ import annotations

import importlib

MODULES = ["q_sources", "q_rows", "q_relational", "q_features", "q_learning"]


def load_all() -> None:
    for name in MODULES:
        importlib.import_module(f"tidecast.workload.{name}")
