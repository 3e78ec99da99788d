"""larder.plans."""
