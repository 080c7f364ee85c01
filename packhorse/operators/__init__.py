"""Transform: quality, keys, history, marts and ordered windows."""
