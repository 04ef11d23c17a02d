"""Writers: raw/processed/curated batches, serving tables, keyed snapshots."""
