"""Where rows go: routed flow files and flow tables."""
