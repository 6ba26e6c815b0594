"""Operators over report pages, grids, records and catalogs."""
