"""Structured Streaming: file-stream sources, foreachBatch sinks, stream forms, stateful prediction."""
