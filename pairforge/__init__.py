"""pairforge: build and score text-to-image retrieval datasets on Spark."""
