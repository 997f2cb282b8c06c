"""Declared tables: one plan per record family, run by the generic readers and expressions."""
