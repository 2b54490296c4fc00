"""Tallyloom: survey analytics and training-data operators, written for PySpark."""
