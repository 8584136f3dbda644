"""Bindings of the operators to the test tables, each beside its SQL check."""

from tidewire.workload import crawl, listings, parsing, reading, seeds, state, storage, streams  # noqa: F401
from tidewire.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
