"""Where event records come from and how they look on the wire."""
