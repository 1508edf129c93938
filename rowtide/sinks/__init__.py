"""Where rows and change events go."""
