"""Named queries: catalogue search, document-model search, event analytics, probe suite."""
