"""Declarative configuration: the rule catalog and the source table list."""

from __future__ import annotations

import copy
from functools import lru_cache
from pathlib import Path

import yaml

RULES_PATH = Path(__file__).with_name("rules.yaml")


@lru_cache(maxsize=8)
def _load(path: str) -> dict:
    with open(path) as fh:
        return yaml.safe_load(fh)


def load_rules(path: str | Path = RULES_PATH) -> dict:
    """Per-table rule specs (a fresh copy; callers may edit it)."""
    return copy.deepcopy(_load(str(path)).get("tables", {}))


TESTS_PATH = Path(__file__).with_name("tests.yaml")
PIPELINE_PATH = Path(__file__).with_name("pipeline.yaml")


def load_pipeline_config(path: str | Path = PIPELINE_PATH) -> dict:
    """Feeds in load order, error policy (continue | stop), source system, load type."""
    cfg = copy.deepcopy(_load(str(path)))
    if cfg.get("error_policy", "continue") not in ("continue", "stop"):
        raise ValueError(f"error_policy must be continue or stop, got {cfg['error_policy']!r}")
    return cfg


def load_tests(path: str | Path = TESTS_PATH) -> list[tuple[str, str, str, str, list | None]]:
    """Flattened constraint specs: (layer, model, column, test, accepted values)."""
    out = []
    for layer, models in _load(str(path)).items():
        for model, columns in models.items():
            for column, tests in columns.items():
                for t in tests:
                    if isinstance(t, dict):
                        (name, values), = t.items()
                        out.append((layer, model, column, name, list(values)))
                    else:
                        out.append((layer, model, column, t, None))
    return out
