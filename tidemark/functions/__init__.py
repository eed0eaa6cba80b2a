"""Column expressions: parsing, clock arithmetic, ratios and grid buckets."""
