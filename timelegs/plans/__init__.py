"""End-to-end batch runs and plan inspection."""
