"""Readers and writers: manifests, codec arrays, sequence stores, count logs."""
