"""Operators for cleaning and encoding training text.  Nothing else imports this."""
