"""The operators put together: staging, star load, one whole run."""
