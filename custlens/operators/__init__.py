"""DataFrame operators: profiles, ordered/segmented windows, medians, encodings, selection, models."""
