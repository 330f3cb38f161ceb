"""Column functions: rounding, calendar, text, portable digests."""
