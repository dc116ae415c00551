"""Input adapters and the catalogue of registered queries."""
