"""Structured Streaming jobs; each shares its plan with the batch form."""
