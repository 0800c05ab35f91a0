"""Relational operators over rasters and regions."""
