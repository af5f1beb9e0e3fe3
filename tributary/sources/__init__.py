"""Where rows come from and go to: declared tables, JSON files, stored tables."""
