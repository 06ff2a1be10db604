"""Reusable table operators: checks, cleaning, keep-latest and order sequence."""
