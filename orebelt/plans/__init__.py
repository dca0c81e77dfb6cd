"""End-to-end flows that run actions: cleaning, star refresh, models, audit views."""
