"""Checks on the generated tables: an adapter, one query per operator and its SQL twin."""
