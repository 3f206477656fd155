"""Registered queries (``queries()``) and their DuckDB oracles (``oracle_sql()``).

Each suite module registers callables ``(spark, sf_dir) -> DataFrame`` with
:func:`tabforge.suite.registry.query`; importing this package loads them all.
"""

from .registry import ORACLE, QUERIES  # noqa: F401
from . import q_business, q_harmonize, q_logs, q_naming, q_plan, q_series, q_sources  # noqa: F401,E402
