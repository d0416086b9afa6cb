"""Writers: fact table, dead letters, published events."""
