"""Readers and writers, and the binding of the finance model to star-schema tables."""
