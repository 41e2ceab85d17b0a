"""The warehouse layers: staging, star schema, rollups, marts, extracts and the build."""
