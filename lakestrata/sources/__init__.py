"""Readers: event logs (bounded, rolling, streaming), derived messages, device templates."""
