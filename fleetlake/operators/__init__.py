"""DataFrame -> DataFrame operators; lazy, no actions inside (except where noted)."""
