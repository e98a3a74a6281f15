"""End-to-end jobs: backfill, update and gap filling."""
