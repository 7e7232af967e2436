"""Inputs: trace scans and normalisation, dimension tables, Parquet readers, test-data mapping."""
