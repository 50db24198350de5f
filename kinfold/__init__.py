"""Customer unification and value analytics as Spark DataFrame operators."""
