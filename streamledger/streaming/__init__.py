"""Structured Streaming: staged feeds, per-batch sinks, jobs and apps."""
