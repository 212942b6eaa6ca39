"""Readers: files and tables in, typed DataFrames out."""
