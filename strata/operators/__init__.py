"""Relational operators: deterministic dedupe, validity filters, DQ metrics."""
