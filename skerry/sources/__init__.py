"""Reading and writing: files, landed payloads, tables."""
