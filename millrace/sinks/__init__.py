"""Writers: the staging area, replaceable tables, append-only logs."""
