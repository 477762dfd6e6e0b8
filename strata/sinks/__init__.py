"""Sinks: partitioned append / partition replace / versioned full replace."""
