"""cinderspark.functions"""
