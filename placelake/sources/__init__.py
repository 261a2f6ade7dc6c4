"""Landing files, the source registry, the processed-file ledger and tables."""
