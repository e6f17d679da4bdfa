"""Frames and what can be done with them."""
