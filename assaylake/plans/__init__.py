"""Multi-step loads built from the operators."""
