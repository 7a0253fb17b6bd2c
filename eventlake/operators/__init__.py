"""DataFrame -> DataFrame operators: capture, verification and analytics."""
