"""Operations on training data: scans, searches, dedup, scoring, mixing, packing."""
