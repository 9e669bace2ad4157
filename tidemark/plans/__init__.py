"""Configuration-driven runs: control tables, audit trail, loads."""
