"""Tessera: entity resolution and record linkage as Spark plans."""
