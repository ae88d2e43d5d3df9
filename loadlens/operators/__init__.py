"""Set-based operators: measures, averages, ranks, as-of lookup, medians, predictions, quality, windows, text."""
