"""Column functions: text normalisation, id tags, buckets, ratios and scores."""
