"""larder.streaming."""
