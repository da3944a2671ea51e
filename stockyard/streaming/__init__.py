"""Streaming: intentionally empty.

The order pipeline this library rebuilds is batch only (real-time ingestion
is listed there as future work), so there is no stream operator to carry
over.  Every operator is a DataFrame function and would run unchanged on a
micro-batch (``foreachBatch``) should a feed arrive as a stream.
"""
