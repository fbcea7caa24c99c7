"""DataFrame -> DataFrame operators. No I/O; shared by batch and stream."""
