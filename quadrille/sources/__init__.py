"""Readers and writers of layers, keyed tables, rasters, job files and file listings."""
