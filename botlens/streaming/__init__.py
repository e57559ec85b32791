"""Structured Streaming: sinks, stateful arrival times and runnable jobs."""
