"""A PySpark retail lake: dated bronze, clean silver, contract-checked gold."""
