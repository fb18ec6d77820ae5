"""Payment reconciliation across independent systems, as Spark DataFrame operators."""
