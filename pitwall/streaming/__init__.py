"""Structured Streaming: keyed-state predictor, three-way split and sinks."""
