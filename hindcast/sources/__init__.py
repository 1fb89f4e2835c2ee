"""Readers and writers for archives, payloads and exports."""
