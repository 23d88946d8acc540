"""Where rows come from: raw logs, flow files, tables, and the events mapping."""
