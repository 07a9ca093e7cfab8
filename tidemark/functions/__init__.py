"""Column functions: conversions, transforms, conditions, labels."""
