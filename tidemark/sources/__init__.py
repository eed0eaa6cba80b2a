"""Reading raw files, describing them, and writing result tables."""
