"""Marketing and commerce analytics as native PySpark DataFrame jobs."""
