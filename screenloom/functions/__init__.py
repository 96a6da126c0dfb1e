"""Subpackage of screenloom; see the README for its contents."""
