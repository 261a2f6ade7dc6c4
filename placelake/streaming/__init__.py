"""Structured Streaming: message sources, replay-safe sinks and the two stream jobs."""
