"""What is read and written: landing files, versioned warehouse tables, run log."""
