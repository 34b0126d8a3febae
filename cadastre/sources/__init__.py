"""Readers: files, pages and services to text frames."""
