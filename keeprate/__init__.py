"""Customer-attrition analytics as Spark DataFrame transformations."""
