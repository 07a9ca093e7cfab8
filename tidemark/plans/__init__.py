"""From configuration to DataFrame plans."""
