"""botlens: finding automated traffic in web-server access logs with Spark."""
