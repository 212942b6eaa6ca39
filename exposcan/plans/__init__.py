"""The lanes and the jobs composed of them, each one lazy DataFrame plan."""
