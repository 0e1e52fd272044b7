"""End-to-end data products and the two config-driven drivers."""
