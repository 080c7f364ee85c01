"""Extract and load: typed reads, quarantine, marks, upserts, partitioned writes."""
