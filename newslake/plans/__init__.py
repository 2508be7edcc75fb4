"""The jobs: page extraction, silver, gold, charts and the whole run."""
