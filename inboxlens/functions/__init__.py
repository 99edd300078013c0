"""Column expressions: regex dialect, mail signals, MIME decoding, clock arithmetic."""
