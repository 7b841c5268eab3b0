"""End-to-end jobs and the checks that run them on the driver's tables."""
