"""Readers and writers of registries, artifacts, manifests, documents and indexes."""
