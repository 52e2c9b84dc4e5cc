"""All queries of this subpackage."""

from dqgate.llm import (  # noqa: F401
    chat_queries,
    corpus_queries,
    dedup_queries,
    page_queries,
    run_queries,
    search_queries,
    text_queries,
)
from dqgate.llm.registry import ORACLE, QUERIES  # noqa: F401
