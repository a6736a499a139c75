"""Operators on DataFrames: conform, gates, dynamic rows, rendering, enrichment, de-duplication, audit."""
