"""The panels are batch tables; there are no streaming operators to rebuild."""
