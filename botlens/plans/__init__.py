"""Complete detectors: from log events to scored, explained windows."""
