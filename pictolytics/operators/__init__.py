"""DataFrame to DataFrame operators over posts, tokens and counts."""
