"""Drug-reference analytics as Spark DataFrame operators."""
