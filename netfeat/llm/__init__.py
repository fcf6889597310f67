"""Training-data operators: quality, toxicity, deduplication, secrets, tokenisation,
packing and language-model scoring. Nothing outside this package imports it."""
