"""Structured Streaming forms: sources, routed foreachBatch outputs, stateful
processors, watermark carry and sinks."""
