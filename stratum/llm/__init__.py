"""Training-data operators: token counts, packing, search, secrets, toxicity, near-duplicates, licences, mixing, LM
scoring, embedding near-duplicates. Nothing else in the library imports this subpackage."""
