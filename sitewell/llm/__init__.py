"""Operators of a training-data pipeline: ten of them, each by one stated method. Nothing else imports this."""
