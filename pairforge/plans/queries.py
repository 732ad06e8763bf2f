"""All queries and their SQL checks by name."""

from pairforge.plans import (
    catalogue_queries,
    frame_queries,
    mixing_queries,
    retrieval_queries,
    source_queries,
    text_queries,
)

MODULES = (
    catalogue_queries, source_queries, text_queries, mixing_queries, retrieval_queries, frame_queries,
)

QUERIES = {name: fn for module in MODULES for name, fn in module.QUERIES.items()}
SQL = {name: sql for module in MODULES for name, sql in module.SQL.items()}
