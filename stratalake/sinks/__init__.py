"""Writers: bronze landing, silver and gold files, warehouse tables."""
