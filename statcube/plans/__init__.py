"""Whole cube reads composed of operators."""
