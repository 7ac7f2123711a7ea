"""Event buckets, sessions, synchronisation and logs."""
