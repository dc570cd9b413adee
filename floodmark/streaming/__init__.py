"""Loading as a stream."""
