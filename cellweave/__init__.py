"""Spark-native analytics over coded raster cells, catalogues and status streams."""
