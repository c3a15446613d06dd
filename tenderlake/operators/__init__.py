"""DataFrame -> DataFrame operators (pure; no storage access)."""
