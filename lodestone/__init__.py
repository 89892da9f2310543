"""Lodestone: mines infrastructure-as-code out of large Parquet corpora of source repositories, on Spark."""
