"""Hospital-visit analytics written as Spark DataFrame operators."""
