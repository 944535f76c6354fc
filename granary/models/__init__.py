"""Models fitted to aggregates of the marts, and their evaluation."""
