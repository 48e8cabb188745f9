"""Operators for cleaning and mixing training text. Nothing outside this folder imports it."""
