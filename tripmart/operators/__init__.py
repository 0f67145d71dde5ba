"""Lazy ``DataFrame -> DataFrame`` operators (no actions except size checks of dimensions)."""
