"""Training-data operators: truncation, residue, pair defects, ranking, sampling, language, repetition, packing, mixing and shared spans."""
