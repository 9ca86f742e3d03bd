"""Teacher and student models."""
