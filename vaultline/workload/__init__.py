"""The registered queries and their SQL counterparts over the test tables."""

from vaultline.workload import batch, streams  # noqa: F401  (fills the registry)
from vaultline.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
