"""Composite plans: what a user calls to go from landed samples to analysis tables."""
