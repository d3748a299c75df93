"""Reporting views and their previews, as functions from tables to DataFrames."""
