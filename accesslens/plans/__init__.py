"""The registered queries, the view they read and their SQL counterparts."""
