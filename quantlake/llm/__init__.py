"""Training-data operators: near and substring duplicates, quality, packing, secrets, tokens, toxicity, top-k."""
