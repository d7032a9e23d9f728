"""Readers, writers and the crawl frontier."""
