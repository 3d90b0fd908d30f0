"""Order analytics on Spark: conform, validate, clean, model and check order lines."""
