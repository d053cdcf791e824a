"""Sources: typed CSV readers, postal look-up, lineage columns, adapter views."""
