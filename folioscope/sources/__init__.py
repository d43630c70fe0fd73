"""Where files, pages and replies come from."""
