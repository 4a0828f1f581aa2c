"""Raw sources: scans, the generator, manifests and batch appends."""
