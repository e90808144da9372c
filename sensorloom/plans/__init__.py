"""Pipelines, analysis queries and read operators wired from the operators."""
