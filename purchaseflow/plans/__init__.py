"""The purchase analyses and the batch jobs around them."""
