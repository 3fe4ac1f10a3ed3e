"""End-to-end plans: load target maps, match, conflate, generate OSM, report quality."""
