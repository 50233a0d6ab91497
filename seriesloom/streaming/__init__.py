from seriesloom.streaming.batching import LiveBatches, batch_stream
from seriesloom.streaming.job import IngestJob, IngestOptions
from seriesloom.streaming.sender import read_outcomes, send_stream
from seriesloom.streaming.sinks import (
    DeliveryFailed,
    DualSink,
    FallbackSink,
    FileSink,
    ListeningSink,
    MissingCredential,
    SendSink,
    TableSink,
)
from seriesloom.streaming.spool import SpoolIngest

__all__ = [
    "DeliveryFailed", "DualSink", "FallbackSink", "FileSink", "IngestJob", "IngestOptions",
    "ListeningSink", "LiveBatches", "MissingCredential", "SendSink", "SpoolIngest", "TableSink", "batch_stream",
    "read_outcomes", "send_stream",
]
