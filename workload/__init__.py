"""Registered queries over the given tables, each with its SQL counterpart."""

from workload import collecting, imputing, models, panels, profiling, quotes, scalars  # noqa: F401
from workload.registry import QUERIES, SQL  # noqa: F401
