"""Document analytics on Spark: records, fields, tags, tables, graph and evaluation as DataFrames."""
