"""Relational operators over the tables the sources give."""
