"""Named plans over the warehouse tables (or the fixture views)."""
