"""The incremental run over a landing folder."""
