"""Training-data operators: archives, extraction, tokens, filters, near duplicates, decontamination, packing."""
