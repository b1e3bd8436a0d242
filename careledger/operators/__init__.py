"""Reusable DataFrame operators: tax allocation, interval sweep-line, result shaping."""
