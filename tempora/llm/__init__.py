"""Training-data operators: mixing, exact search, quality rules, binary
output, near-duplicates, language ID, chat formatting, piece encoding,
substring dedup and HTML extraction, each as Spark jobs."""
