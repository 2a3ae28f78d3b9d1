"""Spark-native zonal assessment engine.

Features, raster tiles and metric tables are ordinary DataFrames; every
operator maps DataFrames to DataFrames and leaves the physical plan to Spark.
"""
