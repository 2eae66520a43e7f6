"""Training-data operators: language, packing, language models, mixing, quality, privacy,
search, near duplicates, page text and toxicity. Nothing outside this package imports it."""
