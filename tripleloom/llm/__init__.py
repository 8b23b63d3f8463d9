"""Operators for preparing training text: near copies, filters, secrets, shards, tokens and packing."""
