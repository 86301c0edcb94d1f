"""Sources and sinks (S1-S11): DataFrame readers and writers; paths are shared storage."""
