"""Plans built from the operators: the catalogue of the reference's tables,
layer runs (pipeline, layer objects), validation, and the registered queries
(queries, single_ops, table_ops, extended)."""
