"""Retail-sales analytics as lazy Spark plans: one purchase fact, article and customer dimensions."""
