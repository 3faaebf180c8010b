"""The checks' workload: stand-in sources over the test tables, queries and their SQL twins."""
