"""obstar: loading observations into a star schema, and serving them, as Spark jobs."""
