"""The aggregate views, their shared builders and the consumer queries."""
