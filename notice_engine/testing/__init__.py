"""Small inputs in the formats that only captured pages and files have."""
