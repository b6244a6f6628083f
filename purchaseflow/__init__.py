"""Purchase-journey analytics as PySpark DataFrame operators."""
