"""DataFrame-to-DataFrame operators; all of them take batch tables, most take streams."""
