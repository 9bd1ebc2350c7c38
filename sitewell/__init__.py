"""Multi-site operations warehouse on Spark: raw feeds -> staging -> marts -> documents."""
