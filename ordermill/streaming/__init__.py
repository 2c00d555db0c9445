"""The rolling question over orders that keep arriving as files."""
