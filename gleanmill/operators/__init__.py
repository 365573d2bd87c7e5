"""Operators on whole tables: DataFrame in, DataFrame out."""
