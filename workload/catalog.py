"""Importing this module registers every query."""

from workload import analytics, boundary, keys, mutation, spatial, tables  # noqa: F401
from workload.registry import REGISTRY  # noqa: F401
