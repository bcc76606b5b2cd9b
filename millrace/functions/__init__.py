"""Column functions: codecs, timestamps and money."""
