"""Readers of landed payloads and the bronze layer."""
