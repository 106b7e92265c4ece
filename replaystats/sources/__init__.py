"""Readers and writers: match documents, id manifests, tables and packed pages."""
