"""Where rows and schemas come from."""
