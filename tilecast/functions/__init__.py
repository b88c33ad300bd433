"""Column expressions: calendar, geohash, error formulas."""
