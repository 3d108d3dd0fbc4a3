"""Readers, writers and the crawled-page scan."""
