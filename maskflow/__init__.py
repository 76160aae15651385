"""Declarative, audited pseudonymisation of records on PySpark."""
