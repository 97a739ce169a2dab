"""cinderspark.plans"""
