"""Multi-step jobs: refresh, publication, acceptance drills and the query registry."""
