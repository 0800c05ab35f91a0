"""Population grids summarised inside regions and drawn as map tiles, on Spark DataFrames."""
