"""Row and group operators; each takes and returns a DataFrame."""
