"""File streams, expectations, type-1 change application and sessions."""
