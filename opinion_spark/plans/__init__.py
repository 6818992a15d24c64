"""Compositions of operators that make up a whole job."""
