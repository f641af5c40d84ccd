"""tracemill streaming."""
