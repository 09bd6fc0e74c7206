"""Query set over the test tables, its SQL oracle, and the card-domain pipeline."""
