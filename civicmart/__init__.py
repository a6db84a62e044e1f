"""Service-request warehouse and reporting on PySpark DataFrames."""
