"""Readers of tables, delimited files, archives, fixed-width tables and landing folders."""
