"""cinderspark.sources"""
