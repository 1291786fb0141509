"""Stages put together, the registered queries and the command line."""
