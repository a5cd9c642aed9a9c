"""Reading the feeds; writing layers, exports and serving tables."""
