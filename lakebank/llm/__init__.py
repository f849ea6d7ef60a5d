"""Training-data operators: quality, personal data, tokens, search, URLs,
licenses, mixing, near duplicates, sharding and page text."""
