"""Column helpers and the few algorithms Spark has no single operator for."""
