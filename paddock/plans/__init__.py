"""Named outputs: cleaned tables, joined tables, dashboard files, tests."""
