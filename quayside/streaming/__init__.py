"""Loading files as they arrive."""

from quayside.streaming.arrivals import stream_dataset, stream_to_table
from quayside.streaming.batches import stream_batches

__all__ = ["stream_batches", "stream_dataset", "stream_to_table"]
