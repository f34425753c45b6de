"""Registered queries over the test tables and their equivalents in standard SQL."""
