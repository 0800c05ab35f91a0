"""Writers of reports and map tiles."""
