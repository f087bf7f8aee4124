"""Document analytics on Spark: layout, language, entity and loss-accounting operators."""
