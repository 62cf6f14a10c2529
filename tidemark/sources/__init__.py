"""Typed readers and repeatable writers."""
