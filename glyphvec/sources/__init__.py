"""Readers. Every reader returns a lazy DataFrame; row order becomes an ``index_id`` column on request."""
