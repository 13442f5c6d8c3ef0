"""Queries over the given test tables, their SQL oracles, and the inputs both share."""
