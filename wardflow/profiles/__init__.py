"""Bindings of the generic operators to concrete schemas."""
