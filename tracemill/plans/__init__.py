"""tracemill plans."""
