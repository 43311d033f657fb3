"""Training-data operators: sharding, scoring, token counts, mixing, quality, language, overlap, captures, copies."""
