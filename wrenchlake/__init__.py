"""Vehicle warranty and service analytics as DataFrame-to-DataFrame functions."""
