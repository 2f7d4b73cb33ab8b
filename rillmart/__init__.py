"""Operators and jobs of a real-time retail warehouse, written as DataFrame functions."""
