"""Registered queries over the driver tables and their SQL oracles."""

from lexiframe.plans.queries import QUERIES  # noqa: F401
from lexiframe.plans.oracle import ORACLE_SQL  # noqa: F401
