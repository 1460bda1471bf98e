"""Where rows come from and where they go: topics, keyed tables, driver tables."""
