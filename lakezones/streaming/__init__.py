"""Incremental loads: a stored watermark for batches, a checkpoint for streams."""
