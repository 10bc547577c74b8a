"""Operators: staging, enrichment, marts, formulas and quality checks."""
