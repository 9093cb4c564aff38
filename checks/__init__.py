"""Registered queries, their SQL twins and the comparison of the two."""
