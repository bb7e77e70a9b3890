"""Where mart rows go: partitioned parquet with key replacement, JDBC."""
