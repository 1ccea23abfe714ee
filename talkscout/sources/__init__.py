"""Readers and writers: manifests, URL index, crawl records, export."""
