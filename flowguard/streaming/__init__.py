"""Structured Streaming: score flows as they arrive, flag unseen labels."""
