"""The pipelines over tables, and the reports on what they store."""
