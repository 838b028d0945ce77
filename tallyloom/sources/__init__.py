"""Readers: parquet tables, manifests, configurations, XML, JSON and HTML catalogues."""
