"""Wellspring: oil and gas public-data engine built on Spark DataFrames."""
