"""Parametrised DataFrame -> DataFrame operators."""
