"""Every registered query of the library: operators bound to the given tables, each with its SQL."""

from __future__ import annotations

from medleaf.plans.cycle import CYCLE_QUERIES
from medleaf.plans.evidence import EVIDENCE_QUERIES
from medleaf.plans.lookups import LOOKUP_QUERIES
from medleaf.plans.records import RECORD_QUERIES
from medleaf.plans.runs import RUN_QUERIES

_ALL = {**LOOKUP_QUERIES, **RECORD_QUERIES, **EVIDENCE_QUERIES, **RUN_QUERIES, **CYCLE_QUERIES}


def queries():
    return {name: query for name, (query, _) in _ALL.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in _ALL.items() if sql}
