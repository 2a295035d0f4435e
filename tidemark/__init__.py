"""tidemark: click-log and order-change analytics as Spark DataFrame plans.

Layout
------
sources/     table loading, topic-shaped records, adapters from the driver tables
functions/   column expressions (time formats, masks, tokens, percentages)
operators/   DataFrame -> DataFrame transforms (dedup, alerts, sales, search,
             metrics, feeds, cells, keyed table)
plans/       the registered queries and their DuckDB oracle SQL
streaming/   Structured Streaming jobs that reuse the same operators
"""

from tidemark.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
