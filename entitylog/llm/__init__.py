"""Operators for preparing training text, and their queries; nothing else imports them."""
