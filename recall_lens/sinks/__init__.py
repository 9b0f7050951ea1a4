"""Writers: append, refresh, upsert and CSV snapshots."""
