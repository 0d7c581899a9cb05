"""Archives kept up to date as files land."""
