"""Column-expression builders; nothing here triggers a Spark job."""
