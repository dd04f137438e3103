"""Millrace: dataset curation and analytics on Spark DataFrames."""
