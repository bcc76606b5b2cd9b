"""DataFrame -> DataFrame steps that work on batch and streaming input alike."""
