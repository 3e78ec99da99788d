"""larder.functions."""
