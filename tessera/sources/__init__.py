"""Sources and sinks: table registry, JSONL landing files, exports."""
