"""Where source rows come from: point-of-sale tables, JDBC, change feeds, the sample tables."""
