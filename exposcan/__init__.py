"""Exposure assessment over decoded file corpora, written as Spark DataFrame jobs."""
