"""Batch operators over lake tables (DataFrame -> DataFrame)."""
