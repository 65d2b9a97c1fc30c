"""Readers for landed feed files and tables; every reader takes an explicit schema."""
