"""Sources: JDBC (partitioned reads), catalog tables and parquet paths,
retry of a table's load, incremental loads by high-water mark, and the
fixture views that map the driver's test tables onto the five source shapes."""
