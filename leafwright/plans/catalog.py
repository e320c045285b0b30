"""All core queries and their SQL."""

from __future__ import annotations

from leafwright.plans import compaction_queries, eval_queries, file_queries, layout_queries, text_queries

QUERIES = {**compaction_queries.QUERIES, **layout_queries.Q, **text_queries.Q, **eval_queries.Q, **file_queries.Q}
SQL = {**compaction_queries.SQL, **layout_queries.SQL, **text_queries.SQL, **eval_queries.SQL, **file_queries.SQL}
