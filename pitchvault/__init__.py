"""Vault and mart operators on PySpark DataFrames."""
