"""Retail sales analytics as plain Spark DataFrame transforms.

Every public function takes DataFrames (or a SparkSession) and returns a
DataFrame. Nothing runs on import and no function changes session settings.
"""
