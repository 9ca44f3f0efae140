"""Millrace: analytics operators written for Spark, DataFrame in and DataFrame out."""
