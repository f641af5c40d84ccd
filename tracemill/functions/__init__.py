"""tracemill functions."""
