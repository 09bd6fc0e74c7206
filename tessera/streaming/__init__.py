"""File-source Structured Streaming that feeds the batch operators per micro-batch."""
