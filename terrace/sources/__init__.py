"""File scans with lineage and the versioned layer tables."""
