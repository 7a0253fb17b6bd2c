"""Column-level building blocks: the envelope, payload access and encoders."""
