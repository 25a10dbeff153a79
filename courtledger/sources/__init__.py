"""Where rows come from and go to: pages, day folders, tables, files."""
