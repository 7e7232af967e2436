"""Column helpers: time arithmetic and the time-bucket / halo skew splitting."""
