"""Training-data operators: dedup, quality, personal data, secrets, scoring,
packing, chat formatting and byte-pair codes, each a Spark job."""
