"""Relational operators, generic over column names: DataFrame in, DataFrame out."""
