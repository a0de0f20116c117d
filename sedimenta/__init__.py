"""Layered (bronze, silver, gold) retail warehouse operators on PySpark DataFrames."""
