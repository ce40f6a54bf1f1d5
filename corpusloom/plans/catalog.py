"""All queries of the engine by name, with the SQL that gives the same rows."""

from __future__ import annotations

from corpusloom.plans import file_plans, layout_plans, record_plans, run_plans, text_plans

_MODULES = [text_plans, layout_plans, record_plans, run_plans, file_plans]
QUERIES = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
