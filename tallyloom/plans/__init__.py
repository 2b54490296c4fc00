"""Queries over the driver's tables; importing registry fills it."""
