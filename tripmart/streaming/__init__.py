"""Incremental triggering of the batch month run (the original is batch-only).

The original pipeline is started by hand for one month at a time. Here a
Structured Streaming file source watches the raw folder; every micro-batch
carries the newly landed files and the months they belong to are cleaned
by the same idempotent batch plan. There are no event-time windows or
state: months that arrive late are simply processed when they land.
"""

from tripmart.streaming.landing import start_landing_stream

__all__ = ["start_landing_stream"]
