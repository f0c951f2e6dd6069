"""Retail demand and stock analytics as Spark DataFrame operators."""
