"""Jobs that read, write and commit: incremental sync and the mart build."""
