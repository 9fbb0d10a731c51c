"""Column expressions: record contract, calendar columns, decimal measures."""
