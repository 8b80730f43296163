"""Readers and writers of transfer, case and graph tables."""
