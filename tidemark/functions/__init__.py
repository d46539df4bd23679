"""Column expressions: fields, row keys, regions, payload getters, buckets."""
