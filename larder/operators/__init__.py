"""larder.operators."""
