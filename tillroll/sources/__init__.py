"""Typed readers and result writers."""
