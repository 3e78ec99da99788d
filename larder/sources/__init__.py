"""larder.sources."""
