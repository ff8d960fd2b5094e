"""Jobs that chain the operators over the store."""
