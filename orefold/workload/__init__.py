"""The library's operators on the star-schema tables, query by query."""
