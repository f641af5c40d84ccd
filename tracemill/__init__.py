"""tracemill package."""
