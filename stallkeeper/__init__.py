"""Marketplace listing change capture and reconciliation on Spark DataFrames."""
