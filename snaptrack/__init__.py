"""Snapshot tracking on Spark: reconcile periodic full dumps into entities and history."""
