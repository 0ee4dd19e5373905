"""Suites as data: YAML text or file to a checked list of expectations."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from typing import Any

import yaml

from plumbline.operators.expectations import rules

# Names a suite gets when its YAML gives none (fixed values).
DEFAULT_ASSET = "default_data_asset"
DEFAULT_BATCH = "default_batch"
DEFAULT_SUITE = "default_validation_suite"


@dataclass(frozen=True)
class Expectation:
    type: str
    kwargs: dict[str, Any] = field(default_factory=dict)
    severity: str = "critical"

    @property
    def column(self) -> str | None:
        return self.kwargs.get("column")


@dataclass(frozen=True)
class Suite:
    expectations: tuple[Expectation, ...]
    name: str = DEFAULT_SUITE
    data_asset_name: str = DEFAULT_ASSET
    batch_definition_name: str = DEFAULT_BATCH

    def valid_values(self, column: str) -> list | None:
        """Allowed values of a column, taken from its in-set rule.

        None where a range rule makes the column a numeric one, empty without any rule.
        """
        allowed: list = []
        for e in self.expectations:
            if e.column == column and e.type == "expect_column_values_to_be_in_set":
                allowed = list(e.kwargs.get("value_set", []))
            elif e.column == column and e.type == "expect_column_values_to_be_between":
                return None
        return allowed


def load_suite(source: str | os.PathLike) -> Suite:
    """Read a suite from a YAML file, or from YAML text when no such file exists."""
    text = source
    if isinstance(source, os.PathLike) or ("\n" not in source and os.path.exists(source)):
        with open(source, encoding="utf-8") as handle:
            text = handle.read()
    raw = yaml.safe_load(text)
    if not isinstance(raw, dict):
        raise ValueError("a suite must be a YAML mapping")
    entries = raw.get("expectations", [])
    if not isinstance(entries, list):
        raise ValueError("'expectations' must be a list")
    return Suite(
        expectations=tuple(_expectation(entry) for entry in entries),
        name=raw.get("expectation_suite_name", DEFAULT_SUITE),
        data_asset_name=raw.get("data_asset_name", DEFAULT_ASSET),
        batch_definition_name=raw.get("batch_definition_name", DEFAULT_BATCH),
    )


def _expectation(entry: Any) -> Expectation:
    if not isinstance(entry, dict) or "expectation_type" not in entry:
        raise ValueError(f"an expectation needs an 'expectation_type': {entry!r}")
    kwargs = dict(entry.get("kwargs") or {})
    severity = kwargs.pop("severity", entry.get("severity", "critical"))
    expectation = Expectation(entry["expectation_type"], kwargs, severity)
    rules.check(expectation)
    return expectation
