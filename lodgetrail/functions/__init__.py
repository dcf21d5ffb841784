"""Scalar helpers and declarative column rules."""
