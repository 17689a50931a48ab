"""Runs that put the operators together."""
