"""DataFrame in, DataFrame out; the row-wise ones serve batches and streams alike."""
