"""cinderspark: burned-area raster and vector analytics as Spark DataFrames."""
