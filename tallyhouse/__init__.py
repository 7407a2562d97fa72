"""Medallion analytics on Spark: reusable operators and the marts built from them."""
