"""The layered data model: silver, gold, contracts, analytics."""
