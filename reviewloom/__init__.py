"""Distributed data operators for the life cycle of a text classifier."""
