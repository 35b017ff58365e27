"""Stratamend: replication, reconciliation and corpus preparation on Spark."""
