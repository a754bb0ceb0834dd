"""The query catalogue: views over the driver tables, queries and their SQL."""
