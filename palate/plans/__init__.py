"""Layers and reports composed of operators."""
