"""Streams of batches: direct appends, appends held back to a threshold, and de-duplication."""
