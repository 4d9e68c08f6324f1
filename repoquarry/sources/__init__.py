"""Readers: file trees, commit logs, metric tables, vocabularies and vectors."""
