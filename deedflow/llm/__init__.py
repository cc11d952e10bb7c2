"""Training-data operators: quality, language, near duplicates, decontamination, search, packing and the like."""
