"""Operators for training-data pipelines: near-duplicates, decontamination, quality, tokens, chats and URLs."""
