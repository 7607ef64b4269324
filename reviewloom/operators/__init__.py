"""The operators, by stage of the life cycle."""
