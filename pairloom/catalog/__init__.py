"""The operators bound to the benchmark tables, each with SQL that states the same result."""
