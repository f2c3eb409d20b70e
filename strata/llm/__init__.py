"""Operators for preparing training text: near copies, languages, quality, toxicity, pages, ids and mixtures."""
