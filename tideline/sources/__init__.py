"""Sources and sinks: options, write-ahead logs, checkpoints."""
