"""Column functions: normal forms, row hashes, bitmaps, dates."""
