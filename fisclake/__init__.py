"""fisclake: a PySpark library that takes electronic fiscal documents from raw XML to query-ready tables."""
