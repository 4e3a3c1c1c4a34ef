"""Walking-catchment analytics on PySpark."""
