"""The pipelines as Structured Streaming queries over the same operators."""
