"""The loads of the three zones, put together from the operators."""
