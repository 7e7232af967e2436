"""Streaming entry: a file-stream trigger that runs the daily jobs for each new trace day."""
