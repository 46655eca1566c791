"""Operators of a training-data pipeline; see ``queries`` for how they are applied."""
