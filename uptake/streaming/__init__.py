"""Results kept up to date from files that arrive, with Structured Streaming."""
