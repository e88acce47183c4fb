"""Registered queries of this subpackage, and their DuckDB SQL."""

from __future__ import annotations

from textlathe.llm import queries_a, queries_b, queries_c, queries_d, queries_e, queries_f, queries_g

_PARTS = (queries_a, queries_b, queries_c, queries_d, queries_e, queries_f, queries_g)

QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLE = {name: sql for part in _PARTS for name, sql in part.ORACLE.items()}
