"""The funnel's own column layout, steps and day job."""
