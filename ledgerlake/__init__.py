"""Card-transaction lakehouse on PySpark."""
