"""The library's operators applied to the test tables, with an independent SQL text for each."""
