"""The analyses: each module turns prepared frames into a deliverable."""
