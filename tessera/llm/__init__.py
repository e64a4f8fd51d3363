"""Training-data operators: licence scan, decontamination, extraction, language, PII, packing, quality, dedup, LM."""
