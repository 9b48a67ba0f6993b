"""Streaming operators.

The analysed application is batch-only: every read is a whole-file read and
there is no watermark, window, stateful or late-data logic to reproduce.
This package is intentionally empty; the batch operators in
:mod:`ledgerlens.operators` work unchanged on micro-batches inside
``foreachBatch`` should a streaming feed appear.
"""
