"""End-to-end flows composed from operators."""
