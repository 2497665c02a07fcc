"""DataFrame transforms: links (A), records (B), entities (C), numbers and the
skew-safe prefix scan (D)."""
