"""The feed, the dimensions, Silver, Gold and the reports."""
