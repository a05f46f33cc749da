"""aeroledger: flight, weather and delay analytics as PySpark DataFrame jobs."""
