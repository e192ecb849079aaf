"""Operators on bars: quality, drops in a window, outliers, drops around outliers."""
