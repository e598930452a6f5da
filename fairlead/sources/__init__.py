"""Sources: registries, feeds, pages and discovery, from bodies that have been landed already."""
