"""DataFrame-to-DataFrame operators; each runs in batch and on the micro-batches of a stream."""
