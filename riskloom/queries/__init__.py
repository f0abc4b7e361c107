"""Every operator as a query over the driver tables, next to the SQL it must equal."""

from __future__ import annotations

from riskloom.queries import frame, merging, modeling, profile, rates, sampling, scoring, tables  # noqa: F401
from riskloom.queries.registry import ORACLES, QUERIES  # noqa: F401
