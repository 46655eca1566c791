"""Recipes made of the operators: the star schema, its reports, and queries over the sample tables."""
