"""Customer-retention analytics as Spark DataFrame transformations."""
