"""Composable PySpark operators for building and maintaining lakehouse tables."""
