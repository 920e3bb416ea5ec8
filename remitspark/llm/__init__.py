"""Operators for preparing training text: packing, dedup, scoring, mixing and archives."""
