"""Case-record migration and analytics as PySpark DataFrame operators."""
