"""Readers: staged JSON lines, the stage layout, stored API pages, incremental extracts."""
