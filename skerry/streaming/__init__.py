"""Structured Streaming: new files, event windows, alerts and checked loads."""
