"""DataFrame operators: schema, filters, deduplication, profiling, sampling,
splitting, packing, generation and evaluation."""
