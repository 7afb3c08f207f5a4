"""Sources: the catalogue, structure files, lookup payloads and folders."""
