"""Table-to-table operators; every one takes the column roles as arguments."""
