"""Sources: feed files (text / tabular), warehouse tables, fixture views."""
