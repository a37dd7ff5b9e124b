"""Column-level helpers (no UDFs): strict numeric casts, text tokenising
and parsing, result formatting, job-spec decoding."""
