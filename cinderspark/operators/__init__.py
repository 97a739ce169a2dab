"""cinderspark.operators"""
