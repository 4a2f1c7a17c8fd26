"""The day-partitioned target table."""
