"""The registered queries."""

from tidewire.plans import arabic_queries, crawl_queries, page_queries, publishing_queries, record_queries, row_queries, search_queries, stream_queries, text_queries  # noqa: F401
from tidewire.plans.registry import PLANS, SQL

__all__ = ["PLANS", "SQL"]
