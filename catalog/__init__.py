"""Registered queries and the SQL each is checked against."""

from catalog.registry import CHECKS, QUERIES  # noqa: F401
from catalog import validation, corruption, repairs, drifts, storage, modelling, flow  # noqa: E402,F401
