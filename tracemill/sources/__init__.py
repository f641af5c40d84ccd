"""tracemill sources."""
