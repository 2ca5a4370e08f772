"""Readers, writers and the customer tables derived from order data."""
