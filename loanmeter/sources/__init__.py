"""Reading and writing: raw CSV, landing snapshots, cleaned Parquet, published scores."""
