"""The questions a user asks, composed from the operators."""
