"""Writers: day partitions, dimension snapshots, dashboard tables."""
