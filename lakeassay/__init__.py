"""Layered tables on Spark: change capture, cleaning, aggregates and quality monitoring."""

import sys

from pyspark import cloudpickle

from lakeassay.checker import TableChecker
from lakeassay.model import (
    DefectSpec,
    ForeignKey,
    RunContext,
    SilverSpec,
    TableSpec,
    Thresholds,
)

__all__ = [
    "DefectSpec",
    "ForeignKey",
    "RunContext",
    "SilverSpec",
    "TableChecker",
    "TableSpec",
    "Thresholds",
]

# Tasks get the library's functions by value, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
