"""Writers: versioned appends, price log, dead letters, CSV export."""
