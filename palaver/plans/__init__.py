"""Stage pipeline, merging and command line."""
