"""The settlement of a period, and the registered queries with their SQL."""
