"""Layered (bronze, silver, gold) lakehouse jobs written as Spark DataFrame transformations."""
