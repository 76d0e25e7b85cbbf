"""Named models, marts, checks and reports built from the operators."""
