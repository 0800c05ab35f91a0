"""Readers: country catalog, GeoJSON regions and raster tables."""
