"""Operators for building large text corpora; nothing outside imports them."""
