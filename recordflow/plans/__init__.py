"""Composition of the operators into one logical plan."""
