"""Operators of a training-data pipeline. Nothing else in fluxgrain imports this package."""
