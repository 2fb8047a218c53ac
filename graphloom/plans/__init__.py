"""Declarations: mappings and the catalog they are checked against."""
