"""Whole stages and the queries that check them."""
