"""DataFrame operators: links, frontier, report, manifest, deduplication, logs."""
