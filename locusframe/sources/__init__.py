"""Readers and writers. Parsers work on line tables, so text in any storage can feed them."""
