"""Subpackage of chunkloom."""
