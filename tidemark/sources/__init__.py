"""Sources, sinks and contracts: typed schemas, CSV/Parquet snapshots, validation and publish."""
