"""The registered queries: each operator and load of the library over the shared test tables."""

from workload.registry import ORACLES, QUERIES
from workload import columns, joins, loads, sinks, sources, values  # noqa: F401  (register)

__all__ = ["ORACLES", "QUERIES"]
