"""Column expressions: text, dates, bands, ratios, statistics, tail probabilities."""
