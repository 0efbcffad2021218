"""Record-level operators: flattening, deduplication, incremental loads, graph, quality."""
