"""Readers: JSON record files, manifests, tables and crawled index pages."""
