"""The jobs that build and check the cleaned tables."""
