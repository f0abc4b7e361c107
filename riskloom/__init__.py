"""Risk analytics for transaction tables, written as Spark DataFrame operators."""
