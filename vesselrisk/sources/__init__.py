"""Sources: landed-table readers, fixture adapters and file loaders."""
