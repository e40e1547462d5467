"""All queries of the library, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import analytics_queries, feed_queries, history_queries, message_queries, page_queries, queue_queries, report_queries, rule_queries, search_queries, sink_queries, stream_queries, tag_queries, tool_queries  # noqa: F401  their queries register themselves
from tidemark.plans.catalog import ORACLES, QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
