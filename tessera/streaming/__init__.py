"""Streaming.

The workload has no stream source, watermark, window or state: its only
incremental write is a batch append of forecast runs (see
``tessera.sources.sinks.append_table``).  Nothing streaming is built here on
purpose; the package stays batch-only, like the workload it mirrors.
"""
