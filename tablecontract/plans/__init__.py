"""Comparing a contract with a table and deciding what to change. Nothing here reads data."""
