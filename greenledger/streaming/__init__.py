"""Streaming: intentionally empty.

The reporting pipeline this library rebuilds is a batch job over one as-of
date; it has no stream source, watermark, window or state. Streaming ingest is
listed there as not implemented, so no streaming operator is offered here.
"""
