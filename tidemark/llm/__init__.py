"""Operators a training-data pipeline needs beside the change capture; nothing else imports this package."""
