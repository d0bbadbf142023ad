"""Training-data operators: thirteen corpus operators, each a Spark job over whole tables.

Nothing else in the library imports this subpackage.  ``queries()`` and ``oracle_sql()`` are the
registered queries; each operator module has its own general interface and states how it treats
nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns.
"""

from __future__ import annotations

from headway.llm.queries import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]
