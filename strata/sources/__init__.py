"""Readers, writers, target tables and lake zones."""
