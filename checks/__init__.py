"""Registered queries: every operator on the driver tables, with the SQL that states its result."""

from checks import frames, functions, matching, relational, scans, statistics  # noqa: F401  (they register)
from checks.registry import ORACLES, QUERIES  # noqa: F401
