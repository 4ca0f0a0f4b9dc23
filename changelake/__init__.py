"""changelake: change-data operators expressed as Spark DataFrame and
Structured Streaming plans.

Subpackages
-----------
functions   Column helpers (hash keys, time parts, JSON text).
sources     Readers: topics, JDBC tables, landed row events, the lake, synthetic rows.
sinks       Writers: the date-partitioned lake, topics, tables, the publish ledger.
operators   Batch operators: envelope decode, audit capture, publish envelope,
            row events, table-map lookup, changelog union.
streaming   Streaming forms: lake append, carried table map, redelivery dedup.
plans       The registered queries and the fixtures they derive from the given tables.
"""

from changelake.session import scratch_path, get_session

__all__ = ["scratch_path", "get_session"]
