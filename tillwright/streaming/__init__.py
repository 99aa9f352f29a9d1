"""Customer events: decode, archive, windowed views, latest event per customer."""
