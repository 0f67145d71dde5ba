"""Scans: raw months, processed tables, reference data, and the fixture derived from ``events``."""
