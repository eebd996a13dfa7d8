"""Market-microstructure analytics as lazy DataFrame -> DataFrame operators."""
