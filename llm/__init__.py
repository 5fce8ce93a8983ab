"""Operators a training-data pipeline needs, and their registered queries."""
