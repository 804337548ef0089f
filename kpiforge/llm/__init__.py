"""Training-data operators: search, tokenizing, mixing, rollups, quality, chat,
toxicity, near duplicates, rules and sharding.  Nothing outside imports this
subpackage; its queries live in ``queries.py``."""
