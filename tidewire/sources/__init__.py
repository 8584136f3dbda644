"""Inputs and outputs: tables, datasets, captured pages, and the per-site adapters."""
