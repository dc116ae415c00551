"""Scalar functions over commands, payloads and log records."""
