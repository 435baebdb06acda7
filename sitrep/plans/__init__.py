"""The phases of dataset building, composed from the operators."""
