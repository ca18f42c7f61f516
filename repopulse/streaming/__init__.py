"""Incremental loading: landed files to bronze, bronze to silver, snapshots to history."""
