"""Training-data operators: ten operators of a corpus pipeline, each by one named method."""
