"""DataFrame operators on records: flatten, normalise, validate, dedupe, clean, merge and more."""
