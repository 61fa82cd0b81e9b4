"""Where rows come from and go to: topics, stored tables, keyed tables, change feed."""
