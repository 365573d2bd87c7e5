"""Readers and writers of line files, delimited files, journals, blobs and state tables."""
