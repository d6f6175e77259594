"""Star-schema warehouse building and querying as Spark DataFrame operators."""
