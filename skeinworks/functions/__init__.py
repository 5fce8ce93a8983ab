"""Part of skeinworks."""
