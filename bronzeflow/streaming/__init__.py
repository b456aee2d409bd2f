"""Streaming append to bronze."""
