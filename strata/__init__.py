"""Condominium ledger analytics on Spark DataFrames."""
