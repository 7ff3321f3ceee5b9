"""regstar: dirty registration records to a star schema, as Spark DataFrame operators."""
