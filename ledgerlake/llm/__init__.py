"""Training-data operators: packing, extraction, scoring, filtering, deduplication, formatting,
decontamination and web-archive records.  Nothing else in the library imports this package."""
