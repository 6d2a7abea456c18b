"""The incremental job as a stream of file batches."""
