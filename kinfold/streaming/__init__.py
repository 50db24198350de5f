from kinfold.streaming.ingest import (
    LATENESS, append_stream, dedup_stream, ingest, quarantine_stream, read_kafka, read_lines,
    staged,
)
from kinfold.streaming.land import Landing, batch_log, land, log_schema, read_batches

__all__ = [
    "LATENESS", "Landing", "append_stream", "batch_log", "dedup_stream", "ingest", "land", "log_schema",
    "quarantine_stream", "read_batches", "read_kafka", "read_lines", "staged",
]
