"""Operators composed into whole tables."""
