"""The same checks over a file stream."""
