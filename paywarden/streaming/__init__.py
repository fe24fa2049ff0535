"""The same steps on streams of transactions."""
