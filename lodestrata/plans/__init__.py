"""What is to be done: planning, refreshing, seeding, and the query catalogue."""
