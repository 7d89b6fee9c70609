"""Structured Streaming: runners, keyed tables and the live patient documents."""

from wardline.streaming.keyed import KeyedTable  # noqa: F401
from wardline.streaming.live import live_documents, start_documents  # noqa: F401
from wardline.streaming.runners import (  # noqa: F401
    VersionedTable, compact_state, context_state, fold_context_batch, ingest_counters, start_append, start_context, start_ingest, start_update_table,
)
