"""Where rows come from and how they are landed: schemas, raw files, CSV, incremental extracts."""
