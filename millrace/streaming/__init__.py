"""Running queries: triggers, checkpoints and sinks."""
