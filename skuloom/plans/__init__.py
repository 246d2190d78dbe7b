"""Registered queries: bindings of the given tables to catalogue inputs, queries and their SQL."""
