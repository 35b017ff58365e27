"""Codecs and scalar functions."""
