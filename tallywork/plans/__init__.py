"""Business metrics and the catalogue of registered queries."""
