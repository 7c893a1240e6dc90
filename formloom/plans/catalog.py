"""The query catalogue: each query with its SQL oracle."""

from __future__ import annotations

from formloom.plans import forms_queries, layout_queries, page_queries, survey_queries

QUERIES = {**forms_queries.QUERIES, **survey_queries.QUERIES, **layout_queries.QUERIES, **page_queries.QUERIES}
ORACLE_SQL = {**forms_queries.ORACLE_SQL, **survey_queries.ORACLE_SQL, **layout_queries.ORACLE_SQL, **page_queries.ORACLE_SQL}
