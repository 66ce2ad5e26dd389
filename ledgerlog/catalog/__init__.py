"""Every named query bound to the sample tables, with the SQL it is checked against."""

from __future__ import annotations

from .registry import ORACLES, QUERIES

from . import basics, logs, reports, streams, tables, text  # noqa: F401,E402  fill the registry

__all__ = ["ORACLES", "QUERIES"]
