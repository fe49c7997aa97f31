"""All registered queries and their comparison SQL."""

from . import other_queries, page_queries, url_queries

QUERIES = {**url_queries.QUERIES, **page_queries.QUERIES, **other_queries.QUERIES}
ORACLE_SQL = {**url_queries.ORACLE_SQL, **page_queries.ORACLE_SQL, **other_queries.ORACLE_SQL}
