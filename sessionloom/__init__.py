"""Clickstream feature engineering on Spark DataFrames.

Raw shop events (view, cart, purchase, ...) become a training table with one row per
session, product and product attributes.  Every operator takes and returns DataFrames.
"""
