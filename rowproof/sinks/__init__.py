"""Where delivered tables and reports are written to."""
