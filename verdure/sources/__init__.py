"""Table catalog, readers, writers and text decoders."""
