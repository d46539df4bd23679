"""The load as a stream of ready buckets."""
