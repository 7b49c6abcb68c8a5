"""Multi-operator jobs: drift check, tuning, promotion."""
