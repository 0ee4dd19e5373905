"""Expectation suites: declare, compile to columns, run in one aggregate, judge."""

from plumbline.operators.expectations.analysis import (  # noqa: F401
    QualityThreshold, adjusted_success_rate, analyze, failed_expectations, record_count, statistics,
)
from plumbline.operators.expectations.rules import RULES  # noqa: F401
from plumbline.operators.expectations.run import run_suite, unexpected_rows  # noqa: F401
from plumbline.operators.expectations.suite import Expectation, Suite, load_suite  # noqa: F401
