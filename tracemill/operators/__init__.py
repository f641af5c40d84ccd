"""tracemill operators."""
