"""Sales reporting operators for Spark: loading, cleaning, dimensions, history and marts."""
