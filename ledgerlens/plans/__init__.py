"""Distributed plan patterns shared by operators, and end-to-end pipelines."""
