"""Sources and sinks: numbered text lines, the postings sample, table storage."""
