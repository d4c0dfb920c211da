"""Lazy DataFrame functions, one module per subject."""
