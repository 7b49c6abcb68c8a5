"""The registered queries over the driver's tables and their SQL, collected from the modules beside this one."""

from __future__ import annotations

from . import queries, sql

LLM_QUERIES = queries.QUERIES
LLM_ORACLES = sql.ORACLES
