"""Training-data operators: dedup, archives, decontamination, packing, classifiers."""
