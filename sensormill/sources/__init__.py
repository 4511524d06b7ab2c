"""Readers of log directory trees. ``keys`` stays independent of the transform side on purpose."""
