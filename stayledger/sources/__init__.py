"""Where bookings come from and where their history is kept."""
