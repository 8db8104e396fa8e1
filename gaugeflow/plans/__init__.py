"""Composed plans: models, analytical queries, dashboard reads, load and the whole flow."""
